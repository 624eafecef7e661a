"""Toxicity by weak supervision.

1. Lexicons. Words and word stems (prefixes) that are far more frequent in texts labelled
   toxic than in others, from the labelled training rows (a bounded number), and fixed
   lists of insults.
2. Voters. Each lexicon group and pattern votes on a text: *toxic* or abstain; one votes
   *clean*. A text's votes are one bit pattern, so everything below works on counts of
   patterns, at most 2**voters of them, whatever the number of rows.
3. Label model. A generative model of patterns given the hidden label: class balance and
   voter accuracies by expectation maximisation over all training rows, known labels kept.
   Voters that agree more than the label explains are correlated; such groups are modelled
   by joint tables, so that they are not counted as independent evidence.
4. Classifier. A logistic regression on the votes, trained on the posterior labels of all
   training rows, gives the score.

Only the text decides a score. Null and empty texts have no words and get the score of the
clean vote alone. A document with several labels is toxic if any of them is 1.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwarden.llm.repeats import mixed
from pairwarden.llm.tables import record
from pairwarden.session import stage

MIN_TEXTS = 4  # toxic texts that hold a feature
MIN_Z = 2.8
CHANCE = 20  # features expected to be chosen by chance, at most; the label model weighs them down
STEMS = (4, 5, 6)
WORD_GROUPS = 6
STEM_GROUPS = 4
MAX_LABELLED = 500_000
MIN_HASHES = 32
MIN_ALIKE = 0.625  # of the smallest hashes, so that two texts count as near copies
MEETINGS = 4
_FLUSH_TOKENS = 200_000

# Insults by language.
INSULTS = {
    "en": "idiot stupid moron loser scum trash pathetic worthless disgusting clown dumb jerk fool bastard bitch "
          "asshole crap retard garbage filth",
    "de": "idiot dumm trottel arschloch versager abschaum widerlich wertlos mistkerl penner depp schlampe drecksau",
    "fr": "idiot stupide imbécile crétin connard salope ordure minable dégueulasse abruti débile bouffon",
    "es": "idiota estúpido imbécil cabrón basura patético asqueroso payaso tonto gilipollas escoria inútil",
}

_WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Lexicon:
    """Groups of words and stems; each group is one voter."""

    words: dict[str, int] = field(default_factory=dict)
    stems: dict[str, int] = field(default_factory=dict)


def tokens(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def _features(words: set[str]) -> set[str]:
    """Words, and stems marked with a hyphen."""
    return words | {w[:k] + "-" for w in words for k in STEMS if len(w) > k}


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: number of texts with each feature."""
    held: Counter[str] = Counter()

    def flush():
        return record(["feature", "n"], [list(held), list(held.values())], [pa.string(), pa.int64()])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.update(_features(set(tokens(text))))
            if len(held) > _FLUSH_TOKENS:
                yield flush()
                held = Counter()
    if held:
        yield flush()


def _prints():
    """Column function: for each of ``MIN_HASHES`` orders of all hashes the smallest hash of three neighbouring words.

    Two texts agree in a share of them that estimates how many of their three-word sequences they share.
    """

    @F.arrow_udf("array<int>")
    def prints(texts: pa.Array) -> pa.Array:
        of = xxhash.xxh3_64_intdigest
        orders = np.random.default_rng(0).integers(0, 2**64, MIN_HASHES, np.uint64)
        out = np.empty((len(texts), MIN_HASHES), np.int32)
        for row, text in enumerate(texts.to_pylist()):
            words = tokens(text)
            n = max(1, len(words) - 2)
            own = np.fromiter((of(" ".join(words[i : i + 3])) for i in range(n)), np.uint64, n)
            least = np.array([mixed(own ^ order).min() for order in orders], np.uint64)
            out[row] = least.astype(np.uint32).view(np.int32)  # low half: evenly spread, unlike the high one
        return pa.ListArray.from_arrays(np.arange(0, out.size + 1, MIN_HASHES, np.int32), out.ravel())

    return prints


def _document_counts(texts: DataFrame) -> DataFrame:
    return texts.mapInArrow(_count_features, "feature string, n long").groupBy("feature").agg(
        F.sum("n").alias("n")
    )


def fit_lexicon(labelled: DataFrame, min_z: float = MIN_Z) -> Lexicon:
    """Lexicon from (text, toxic) rows: features whose log odds differ by ``min_z`` standard errors.

    Candidates are all features in ``MIN_TEXTS`` toxic texts; their toxic and clean counts meet in a
    join. The more candidates there are, the less likely by chance a count must be (a bound of
    the binomial tail), so that about ``CHANCE`` features are chosen wrongly; what a language's few
    toxic texts share counts as much as in any other. The lexicon is as large as the labelled rows make it.
    """
    sizes = {r.toxic: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad:
        return Lexicon()
    toxic, clean = (labelled.filter(F.col("toxic") == y).select("text") for y in (1, 0))
    found = stage(_document_counts(toxic).filter(F.col("n") >= MIN_TEXTS), "toxic-features")
    clean_counts = _document_counts(clean).withColumnRenamed("n", "m")
    both = found.join(clean_counts, "feature", "left").withColumn("m", F.coalesce("m", F.lit(0)))
    n, m = F.col("n"), F.col("m")
    odds = F.log((n + 0.5) / (bad - n + 0.5)) - F.log((m + 0.5) / (F.greatest(F.lit(0), good - m) + 0.5))
    z = odds / F.sqrt(1 / (n + 0.5) + 1 / (m + 0.5))
    share, part = bad / (bad + good), n / (n + m)
    rest = F.when(m > 0, m * F.log((1 - part) / max(1 - share, 1e-12))).otherwise(0.0)
    unlikely = n * F.log(part / share) + rest  # - log of the bound
    needed = float(np.log(max(1, found.count()) / CHANCE)) if good else 0.0
    chosen = both.filter((odds > 2.5) & (z > min_z) & (unlikely >= needed)).select((-z).alias("z"), "feature")
    lexicon = Lexicon()
    taken: set[str] = set()
    for _, feature in sorted(chosen.collect()):  # of a bounded number of labelled texts
        if feature.endswith("-"):
            if not any(feature[:k] + "-" in taken for k in STEMS if k < len(feature) - 1):
                taken.add(feature)  # a stem of a chosen stem adds nothing
                lexicon.stems[feature[:-1]] = len(lexicon.stems) % STEM_GROUPS
        else:
            lexicon.words[feature] = len(lexicon.words) % WORD_GROUPS
    return lexicon


def _families(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(text, toxic) of labelled rows, one of each family of near copies with one label.

    Near copies count once, else the rare words of a text with many copies would look typical. In each round
    rows with one label meet by one of their smallest hashes; those that agree with the first of them in
    ``MIN_ALIKE`` of all their smallest hashes are left out. Whatever else meets there stays, and a text that
    stays keeps its own label. At most about ``MAX_LABELLED`` labels, chosen by hash, are used; so many ids are
    broadcast, and no text is shuffled or written.
    """
    share = min(1.0, MAX_LABELLED / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    kept = (
        rows.join(F.broadcast(chosen), "doc_id")
        .select("doc_id", F.xxhash64("text").alias("text_hash"), "toxic", _prints()("text").alias("prints"))
        .groupBy("toxic", "prints")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("row"))
    )
    for at in range(MEETINGS):
        kept = stage(kept.withColumn("met", F.col("prints")[at]), "families")
        first = kept.groupBy("toxic", "met").agg(F.min(F.struct("row", "prints")).alias("first"))
        same = F.zip_with("prints", "first.prints", lambda a, b: (a == b).cast("int"))
        alike = F.aggregate(same, F.lit(0), lambda total, one: total + one)
        kept = (
            kept.join(first, ["toxic", "met"])
            .filter((F.col("row") == F.col("first.row")) | (alike < int(MIN_ALIKE * MIN_HASHES)))
            .select("toxic", "prints", "row")
        )
    one = stage(kept.select("row.*", "toxic"), "families")
    return rows.withColumn("text_hash", F.xxhash64("text")).join(F.broadcast(one), ["doc_id", "text_hash"]).select(
        "text", "toxic")


#: Voters in the order of their bits; all vote toxic but the last.
VOTERS = [
    *[f"insults_{lang}" for lang in INSULTS],
    *[f"words_{g}" for g in range(WORD_GROUPS)],
    *[f"stems_{g}" for g in range(STEM_GROUPS)],
    "two_hits", "four_hits", "dense", "very_dense", "shouting", "nothing_found",
]


def votes(text: str | None, lexicon: Lexicon) -> int:
    """Bit pattern of all voters."""
    words = tokens(text)
    distinct = set(words)
    out, bad = 0, set()
    for bit, group in enumerate(_INSULT_SETS):
        hit = distinct & group
        if hit:
            out |= 1 << bit
            bad |= hit
    base = len(_INSULT_SETS)
    for w in distinct & lexicon.words.keys():
        out |= 1 << (base + lexicon.words[w])
        bad.add(w)
    base += WORD_GROUPS
    if lexicon.stems:
        for w in distinct:
            for k in STEMS:
                if len(w) > k and w[:k] in lexicon.stems:
                    out |= 1 << (base + lexicon.stems[w[:k]])
                    bad.add(w)
    base += STEM_GROUPS
    hits = sum(w in bad for w in words) if bad else 0
    share = hits / max(1, len(words))
    loud = 2 * sum(map(str.isupper, text)) > len(text) if text and bad else False
    for bit, vote in enumerate((hits >= 2, hits >= 4, share > 0.004, share > 0.015, loud, not hits)):
        out |= bool(vote) << (base + bit)
    return out


_INSULT_SETS = [frozenset(v.split()) for v in INSULTS.values()]


def _vote_column(lexicon):
    @F.arrow_udf("int")
    def vote(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = lexicon.value
        for batch in texts:
            yield pa.array([votes(t, own) for t in batch.to_pylist()], pa.int32())

    return vote


@dataclass
class LabelModel:
    """Class balance and one table per group of correlated voters: P(votes of the group | label)."""

    groups: list[list[int]]
    balance: float
    tables: list[np.ndarray]

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(toxic | votes) of each pattern."""
        odds = np.full(len(patterns), np.log(self.balance / (1 - self.balance)))
        for group, table in zip(self.groups, self.tables, strict=True):
            state = _states(patterns, group)
            odds += np.log(table[1, state]) - np.log(table[0, state])
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def _states(patterns: np.ndarray, group: list[int]) -> np.ndarray:
    return sum((patterns >> voter & 1) << i for i, voter in enumerate(group))


def _expectation_maximisation(patterns, counts, labels, groups, start, rounds=30) -> LabelModel:
    """``labels``: 1, 0 or -1 (unknown) of each row of the histogram; ``start``: P(toxic)."""
    p = start
    for _ in range(rounds):
        model = _maximise(patterns, counts, groups, p)
        new = np.where(labels >= 0, labels, model.posterior(patterns))
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return model


def _maximise(patterns, counts, groups, p) -> LabelModel:
    total = counts.sum()
    tables = []
    for group in groups:
        state, size = _states(patterns, group), 1 << len(group)
        table = np.stack([np.bincount(state, counts * w, size) for w in (1 - p, p)]) + 1 / size  # smoothed
        tables.append(table / table.sum(axis=1, keepdims=True))
    balance = np.clip((counts * p).sum() / total, 1e-6, 1 - 1e-6)
    return LabelModel(groups, float(balance), tables)


def _correlated(patterns, counts, p, least: float = 0.15, largest: int = 6) -> list[list[int]]:
    """Groups of voters whose votes correlate given the label."""
    n = len(VOTERS)
    bits = (patterns[:, None] >> np.arange(n) & 1).astype(float)
    strength = np.zeros((n, n))
    for w in (counts * p, counts * (1 - p)):
        if w.sum() < 10:
            continue
        mean = (w[:, None] * bits).sum(0) / w.sum()
        centred = bits - mean
        cov = (centred * w[:, None]).T @ centred / w.sum()
        deviation = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        strength = np.maximum(strength, np.abs(cov / np.outer(deviation, deviation)))
    group = {i: [i] for i in range(n)}
    pairs = sorted(((strength[i, j], i, j) for i in range(n) for j in range(i)), reverse=True)
    for s, i, j in pairs:
        if s < least:
            break
        a, b = group[i], group[j]
        if a is not b and len(a) + len(b) <= largest:
            a += b
            for k in b:
                group[k] = a
    return [g for i, g in group.items() if g[0] == i]


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> LabelModel:
    """Label model of a histogram of (pattern, label or -1)."""
    positive = _states(patterns, list(range(len(VOTERS) - 1))) > 0
    known = labels >= 0
    prior = (counts * (labels == 1)).sum() / max(1, (counts * known).sum())
    start = np.where(known, labels, np.where(positive, 0.5, min(0.01, prior)))
    single = [[i] for i in range(len(VOTERS))]
    first = _expectation_maximisation(patterns, counts, labels, single, start)
    p = np.where(known, labels, first.posterior(patterns))
    groups = _correlated(patterns, counts, p)
    return _expectation_maximisation(patterns, counts, labels, groups, p)


def fit_classifier(patterns, counts, target, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (bias first) of a logistic regression on votes, by Newton steps; ``target``: P(toxic)."""
    n = len(VOTERS)
    x = np.c_[np.ones(len(patterns)), patterns[:, None] >> np.arange(n) & 1].astype(float)
    weights = np.zeros(n + 1)
    ridge = np.diag(np.r_[1e-6, np.full(n, penalty)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ weights))
        slope = x.T @ (counts * (target - p)) - ridge @ weights
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        weights += step * min(1, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``threshold`` on) and votes of every row.

    ``labels`` (doc_id, toxic) are used for rows that the condition ``held_out`` leaves for training only.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("held_out", held_out)
    known = labels.filter("toxic is not null and doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max("toxic").alias("toxic"))
    lexicon = context.broadcast(fit_lexicon(_families(rows.filter(~F.col("held_out")), known)))
    voted = stage(
        rows.select("doc_id", "held_out", _vote_column(lexicon)("text").alias("votes")), "votes"
    )
    training = voted.filter(~F.col("held_out")).join(known, "doc_id", "left")
    histogram = training.groupBy("votes", F.coalesce("toxic", F.lit(-1)).alias("toxic")).count().collect()
    if not histogram:  # nothing to learn from
        weights = np.zeros(len(VOTERS) + 1)
    else:
        patterns, given, counts = np.array(histogram, np.int64).T
        model = fit_label_model(patterns, counts.astype(float), given)
        target = np.where(given >= 0, given, model.posterior(patterns))
        weights = fit_classifier(patterns, counts.astype(float), target)
    linear = F.lit(float(weights[0]))
    for bit, w in enumerate(weights[1:]):
        linear = linear + F.lit(float(w)) * F.col("votes").bitwiseAND(1 << bit).cast("boolean").cast("int")
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-linear))
    return voted.select(
        "doc_id", "held_out", score.alias("score"), (score >= threshold).cast("int").alias("predicted"), "votes"
    )
