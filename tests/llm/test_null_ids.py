"""Rows without an id take part in the links of fingerprints."""

from pyspark.sql import functions as F

from larder.llm import simhash

from .conftest import by_row


def test_rows_without_ids_link(spark, monkeypatch):
    prints = [(5, 0b0), (None, 0b11), (3, 0b1111), (None, 1 << 40 | 1 << 50 | 1 << 60), (9, 255 << 20), (9, 255 << 50)]
    df = spark.createDataFrame(prints, "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *rest: docs)
    got = simhash.simhash_components(df).withColumn("fp", F.conv("fingerprint", 16, 10).cast("long"))
    expected = [(5, 0b0, 3), (None, 0b11, 3), (3, 0b1111, 3), (None, prints[3][1], None), (9, 255 << 20, 9), (9, 255 << 50, 9)]
    assert by_row(got, "doc_id", "fp", "component_id") == sorted(expected, key=lambda r: [(x is not None, x) for x in r])
