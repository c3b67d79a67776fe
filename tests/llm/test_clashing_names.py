"""Columns named like the operators' own, and long runs of blanks."""

import time

import pytest
from edulens.llm import decontaminate, license_scan, mixing, ngram_join, quality, sharding
from pyspark.sql import functions as F

NAMES = ["_metadata", "__file", "__row", "__slot", "__number", "__chunk", "file", "row", "key", "value", "number", "block", "size", "shard", "slot"]


@pytest.fixture(scope="module")
def plain(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (2, text), (3, text + " more"), (4, " ".join(f"other{i}" for i in range(40))), (None, None), (5, "")]
    return spark.createDataFrame([(*r, "s", "en", 1) for r in rows], "doc_id long, text string, source string, lang string, n_chars long")


@pytest.fixture(scope="module", params=["frame", "files"])
def clash(request, spark, plain, tmp_path_factory):
    df = plain.select("*", *[F.lit(k).alias(n) for k, n in enumerate(NAMES)])
    if request.param == "frame":
        return df
    path = str(tmp_path_factory.mktemp("clash") / "docs")
    df.write.parquet(path)
    return spark.read.parquet(path)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_give_the_columns_back(spark, plain, clash):
    bench = spark.createDataFrame([("b", "nothing of this kind")], "item_id string, text string")
    for stage in (mixing.in_mixed_order, quality.keep_good, lambda d: ngram_join.keep_one_of_each(spark, d),
                  lambda d: decontaminate.drop_contaminated(d, bench)):
        got = stage(clash)
        assert got.columns == clash.columns
        kept = [r[: len(plain.columns)] for r in sorted_rows(got)]
        assert sorted(kept, key=str) == sorted_rows(stage(plain))
        assert {r[len(plain.columns) :] for r in sorted_rows(got)} <= {tuple(range(len(NAMES)))}


def test_operators_read_their_own_columns(spark, plain, clash):
    for operator in (lambda d: ngram_join.ngram_jaccard_join(spark, d), sharding.shard_by_bytes, lambda d: mixing.mix(d).drop("file", "row")):
        assert sorted_rows(operator(clash)) == sorted_rows(operator(plain))


def test_license_of_long_blank_runs(spark):
    """Time grows with the length, not with its square: 1 MB of blanks after the word, and each step of the claim's pattern."""
    blank = " " * 1_000_000
    texts = ["copyright" + blank, f"copyright (c){blank}1989, 1991{blank}free{blank}x", f"copyright{blank}[yyyy]{blank}", f"(c){blank}copyright{blank}",
             "copyright\\n" * 20_000 + blank]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    began = time.time()
    got = license_scan.scan(frame, license_scan.known_licences(spark)).collect()
    assert len(got) == len(texts) and all(r["license_id"] is None for r in got) and time.time() - began < 120


def test_own_claims_are_still_left_out(spark):
    gpl = "Everyone is permitted to copy"
    claims = ["Copyright (C) 1989, 1991 Free Software Foundation, Inc.,", "Copyright  Free Software Foundation, Inc.",
              "Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>", "copyright [yyyy] [name of copyright owner]",
              "Copyright (C) <year>  <name of author>", "Copyright (c) ____", "Copyright\n19yy   your name"]
    rows = [(k, f"{c} {gpl}") for k, c in enumerate(claims)] + [(99, gpl)]
    digests = {r["d"] for r in spark.createDataFrame(rows, "k int, t string").select(license_scan.digest(F.col("t")).alias("d")).collect()}
    assert len(digests) == 1
