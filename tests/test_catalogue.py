"""Every registered query with SQL gives DuckDB's rows, and a wrong one would be seen."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__
from quireflow.plans import catalogue

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def plain(v):
    if isinstance(v, float | decimal.Decimal):
        return None if math.isnan(v) else round(float(v), 6)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    got = rows_of(df.columns, df.collect())
    if name in catalogue.oracle_sql():
        want = duck.execute(catalogue.oracle_sql()[name])
        names = [d[0] for d in want.description]
        assert sorted(names) == sorted(df.columns)
        assert got == rows_of(names, want.fetchall())
    else:
        assert got


def test_a_wrong_formula_is_seen(spark, duck):
    wrong = catalogue.oracle_sql()["strip_regions"].replace("0.1::DOUBLE", "0.2::DOUBLE")
    df = catalogue.queries()["strip_regions"](spark, DATA)
    want = duck.execute(wrong)
    assert rows_of(df.columns, df.collect()) != rows_of([d[0] for d in want.description], want.fetchall())


def test_images_hold_whole_texts(spark, duck):
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    images = {r.doc_id: r.image for r in catalogue._images(spark, DATA).collect()}
    sizes = {i: max(24, -(-len(t) // 16)) for i, t in texts.items()}
    for i, t in texts.items():
        assert (images[i].height, images[i].width) == (sizes[i], 16)
        assert bytes(images[i].data).decode() == "".join(c if c < "\x80" else "?" for c in t).ljust(sizes[i] * 16)
    turned = {r.doc_id: (r.height, r.width, r.error) for r in catalogue.image_rotate(spark, DATA).collect()}
    assert turned == {i: ((n, 16, None) if i % 4 in (0, 3) else (16, n, None)) for i, n in sizes.items()}


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalogue.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
