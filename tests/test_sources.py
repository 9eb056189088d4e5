"""Readers and sinks."""

import json
import os
import tempfile

from shoplens import operators as op
from shoplens.schemas import ORDER
from shoplens.sources import (
    read_catalog_table,
    read_parquet_table,
    read_text_log,
    to_json_lines,
    write_report,
)
from shoplens.sources import canonical as src
from tests.conftest import SF_SMALL


def test_text_log_directory(spark):
    folder = tempfile.mkdtemp(prefix="shoplens-txt-")
    for i, lines in enumerate([["1\t2\tshoes\t3", "bad line"], ["4\t5\tshoes\t6", "7\t8\thats"]]):
        with open(os.path.join(folder, f"log-{i}.txt"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    log = read_text_log(spark, folder)
    assert log.columns == ["value"] and log.count() == 4
    assert sorted(tuple(r) for r in op.search_word_counts(log).collect()) == [("hats", 1), ("shoes", 2)]


def test_catalog_table_is_narrowed_to_the_schema(spark):
    o = src.orders(spark, SF_SMALL)
    o = o.withColumn("extra", o["order_id"])
    o.createOrReplaceTempView("shoplens_test_orders")
    got = read_catalog_table(spark, "shoplens_test_orders", ORDER)
    assert [(f.name, f.dataType) for f in got.schema.fields] == [(f.name, f.dataType) for f in ORDER.fields]
    assert got.count() == o.count()


def test_parquet_reader_uses_declared_schema_and_infers_otherwise(spark):
    assert read_parquet_table(spark, SF_SMALL, "orders").columns[0] == "o_orderkey"
    # a table without a declared schema is inferred from its footer
    assert "r_name" in read_parquet_table(spark, SF_SMALL, "region").columns


def test_json_lines_and_partitioned_report(spark):
    df = spark.createDataFrame([("2024-01-01", 3, None), ("2024-01-02", 5, "x")], "day string, n long, note string")
    lines = [json.loads(r["value"]) for r in to_json_lines(df).orderBy("value").collect()]
    assert lines == [{"day": "2024-01-01", "n": 3}, {"day": "2024-01-02", "n": 5, "note": "x"}]
    out = os.path.join(tempfile.mkdtemp(prefix="shoplens-out-"), "report")
    write_report(df, out, fmt="json", partition_by=["day"])
    assert {"day=2024-01-01", "day=2024-01-02"} <= set(os.listdir(out))
    assert spark.read.json(out).count() == 2
