"""JSON column functions and the record schemas of the logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Schema of one application log record.
LOG_RECORD = """
common struct<ar:string,ba:string,ch:string,is_new:string,md:string,mid:string,os:string,uid:string,vc:string,sid:string>,
page struct<item:string,item_type:string,last_page_id:string,page_id:string,from_pos_id:string,from_pos_seq:string,refer_id:string,during_time:bigint>,
start struct<entry:string,loading_time:bigint>,
actions array<struct<action_id:string,item:string,item_type:string,ts:bigint>>,
action array<struct<action_id:string,item:string,item_type:string,ts:bigint>>,
displays array<struct<item:string,item_type:string,pos_id:int,pos_seq:int>>,
err struct<error_code:int,msg:string>,
ts bigint
"""

# Schema of one change-data envelope.
CHANGE_RECORD = (
    "op string, before map<string,string>, after map<string,string>, "
    "source map<string,string>, ts_ms bigint"
)


def parse_records(df: DataFrame, column: str, schema: str, into: str = "rec") -> DataFrame:
    """Parse a JSON column; ``is_dirty`` marks text that is no JSON object."""
    with_corrupt = schema.strip().rstrip(",") + ", _corrupt string"
    parsed = F.from_json(
        F.col(column), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    out = df.withColumn(into, parsed)
    dirty = F.col(column).isNotNull() & (F.col(into).isNull() | F.col(f"{into}._corrupt").isNotNull())
    return out.withColumn("is_dirty", dirty)


def append_to_json_array(array_json: Column, element_json: Column) -> Column:
    """Append one string element to a JSON array of strings."""
    values = F.coalesce(F.from_json(array_json, "array<string>"), F.array().cast("array<string>"))
    return F.to_json(F.concat(values, F.array(element_json)))


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """Lift the fields of a struct column to the top level and drop it."""
    return df.select("*", f"{column}.*").drop(column)
