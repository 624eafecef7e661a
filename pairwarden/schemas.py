"""Fixed schemas of the inputs and result tables (nothing is inferred)."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(text: str) -> StructType:
    kinds = {
        "s": StringType(),
        "l": LongType(),
        "i": IntegerType(),
        "d": DoubleType(),
        "b": BooleanType(),
        "t": TimestampNTZType(),
    }
    fields = (part.split(":") for part in text.split())
    return StructType([StructField(name, kinds[kind]) for name, kind in fields])


RULE = _struct("rule_id:l kind:i source:s state:s predicate:s")
RULE_MAP = _struct("multi_id:l rule_id:l kind:i state:s")
CATALOGUE = _struct("tag_name:s type:s")
VERSIONS = _struct("version:t n_files:l")

SINGLE_EVENT = _struct("time:t ip:s type:s single_rule:l hash:s version:t id:s milli_time:s")
PAIR_RESULT = _struct(
    "f_time:t f_ip:s f_type:s f_single_rule:l f_hash:s f_id:s f_milli_time:s "
    "b_time:t b_ip:s b_type:s b_single_rule:l b_hash:s b_id:s b_milli_time:s "
    "corr:l ai_rmse:d ai_rmse_scaled:d ai_label:b f_asset:s b_asset:s version:t"
)
SAME_KIND_RESULT = _struct(
    "f_time:t f_ip:s f_type:s f_single_rule:l f_hash:s f_id:s "
    "b_time:t b_ip:s b_type:s b_single_rule:l b_hash:s b_id:s "
    "corr:l ai_rmse:d ai_rmse_scaled:d ai_label:b version:t"
)
SIMILAR_RESULT = _struct(
    "f_time:t f_ip:s f_type:s f_single_rule:l f_hash:s f_id:s f_milli_time:s "
    "b_time:t b_ip:s b_type:s b_single_rule:l b_hash:s b_id:s b_milli_time:s "
    "ai_rmse:d ai_label:b cos_sim:d corr:l version:t threshold:d"
)
TAG_PREPARED = _struct(
    "hash:s message_id:s operate_info_id:s send_time:s unit_id:s tag_name:s tag_value:d "
    "tag_time:s date_time:t trans_tag:s version:t"
)
TAG_RESULT = _struct(
    "hash:s time_line:t message_id:s operate_info_id:s send_time:s unit_id:s tag_name:s "
    "tag_value:d tag_time:s date_time:t trans_tag:s ai_rmse:d ai_rmse_scaled:d ai_label:b "
    "ai_threshold:d version:t"
)
FIT_HISTORY = _struct(
    "model_id:l model_type:s train_time:t validation_time:t version:t loss:d epoch:i data_shape:s"
)
