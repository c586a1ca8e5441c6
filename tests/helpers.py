import json

from pyspark.sql import DataFrame, SparkSession


def docs_from_json(spark: SparkSession, node_ddl: str, docs: list[dict], store: str = "store-1.myshopify.com",
                   extra_ddl: str = "") -> DataFrame:
    """Documents (one JSON object each) read with an explicit node schema, plus store_name."""
    rows = [json.dumps(dict(d, store_name=d.get("store_name", store)), ensure_ascii=False) for d in docs]
    ddl = node_ddl + ", store_name string" + (", " + extra_ddl if extra_ddl else "")
    return spark.read.schema(ddl).json(spark.sparkContext.parallelize(rows, 1))


def money(x) -> dict:
    return {"shopMoney": {"amount": None if x is None else str(x)}}


def stores(spark, tz="America/New_York", store="store-1.myshopify.com"):
    return spark.createDataFrame([(store, tz)], "merchant string, iana_timezone string")
