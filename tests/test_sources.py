import os
import tempfile

from framewright.sources import readers as RDR
from framewright.sources import sinks as SK


def test_scan_parquet_where_is_nan_safe_and_pushed(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="fw-src-", dir="/tmp"), "t.parquet")
    spark.createDataFrame([(1, 50.0), (2, float("nan")), (3, 10.0), (4, None)], "k int, x double") \
        .write.parquet(path)
    df = RDR.scan_parquet(spark, path, where={"x": (20, None)})
    assert [r.k for r in df.collect()] == [1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(x,20" in plan
    full = {r.k: r.x for r in RDR.scan_parquet(spark, path).collect()}
    assert full[2] is None and full[4] is None


def test_csv_null_tokens_and_inference(spark):
    d = tempfile.mkdtemp(prefix="fw-csv-", dir="/tmp")
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write("a,b,c\n1,x,1.5\nNA,y,N/A\n3,,2\n")
    df = RDR.scan_csv(spark, d)
    types = dict(df.dtypes)
    assert types == {"a": "bigint", "b": "string", "c": "double"}
    rows = sorted(df.collect(), key=lambda r: (r.a is None, r.a or 0))
    assert rows[0].a == 1 and rows[2].a is None and rows[1].b is None and rows[2].c is None


def test_row_number_dense_in_key_order(spark):
    df = spark.range(0, 1000).selectExpr("(id * 7919) % 1000 AS k", "id AS v")
    out = SK.with_row_number(df, ["k"], partitions=7).collect()
    assert sorted((r["index"], r["k"]) for r in out) == [(i, i) for i in range(1000)]


def test_csv_quotes_line_breaks_and_lot_codes(spark):
    d = tempfile.mkdtemp(prefix="fw-csv-", dir="/tmp")
    with open(os.path.join(d, "a.csv"), "w", newline="") as fh:
        fh.write('id,text,lot,n\n1,"say ""hi"" now",12d,1e3\n2,"two\nlines, one cell",5f,.5\n3, NA ,7,-2.\n')
    df = RDR.scan_csv(spark, d)
    assert dict(df.dtypes) == {"id": "bigint", "text": "string", "lot": "string", "n": "double"}
    rows = [(r.id, r.text, r.lot, r.n) for r in df.orderBy("id").collect()]
    assert rows == [(1, 'say "hi" now', "12d", 1000.0), (2, "two\nlines, one cell", "5f", 0.5), (3, " NA ", "7", -2.0)]
    SK.sink_csv(df, os.path.join(d, "out"), sep="\t")
    assert [(r.id, r.text, r.lot, r.n) for r in RDR.scan_tsv(spark, os.path.join(d, "out")).orderBy("id").collect()] == rows
    part = next(f for f in os.listdir(os.path.join(d, "out")) if f.startswith("part-") and f.endswith(".csv"))
    import csv
    with open(os.path.join(d, "out", part), newline="") as fh:
        assert all(len(r) == 4 for r in csv.reader(fh, delimiter="\t"))
