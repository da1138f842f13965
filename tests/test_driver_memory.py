"""What the driver holds does not grow with the rows that matched."""

from pyspark.sql import functions as F

from palimpsest import session
from palimpsest.operators import needles, row_address
from palimpsest.session import BROADCAST_BYTES_CONF, broadcast_limit

ROWS = 2100  # a file's last rows are in a block of their own


def table_with_marks(spark, folder, files=6):
    """A table in files of equal size, and marks on two of three rows, in codes from 1 to 3."""
    rows = spark.range(ROWS * files).select("id", F.concat(F.lit("row "), F.col("id").cast("string")).alias("doc"))
    rows.repartitionByRange(files, "id").write.parquet(str(folder / "t"))
    placed = row_address.addressed(spark.read.parquet(str(folder / "t")))
    code = (F.col("id") % 4).cast("int").alias("_code")
    return placed, placed.where("id % 4 > 0 and id % 3 < 2").select(row_address.FILE, row_address.ROW, code)


def test_marks_are_packed_before_they_meet_the_rows(spark, tmp_path):
    placed, marks = table_with_marks(spark, tmp_path)
    assert session.measured_bytes(marks) > 20 * 40_000
    for limit, broadcasts in ((40_000, 1), (0, 0)):
        spark.conf.set(BROADCAST_BYTES_CONF, str(limit))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            found = row_address.marked(placed, marks)
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert plan.count("BroadcastExchange") == broadcasts and "Union" not in plan
            assert plan.count("Exchange hashpartitioning") == (0 if broadcasts else 2)
            assert found.columns == [*placed.columns, "_code"]
            got = {r["id"]: r["_code"] for r in found.collect()}
        finally:
            spark.conf.unset(BROADCAST_BYTES_CONF)
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == {k: k % 4 if k % 3 < 2 else 0 for k in range(6 * ROWS)}


def test_few_names_beside_many_addresses_are_known_in_the_scan(spark, monkeypatch):
    monkeypatch.setattr(needles, "FEW_ANCHORS", 5)
    wanted = [(f"a{k}.b{k}@x.org",) for k in range(40)] + [("Ada",), ("Berg",)]
    prepared = needles.prepare(spark.createDataFrame(wanted, "needle string"))
    texts = spark.createDataFrame([(1, "Bo Al Ada Be Berg a7.b7@x.org"), (2, "Al Bo c@x.org"), (3, None)], "i int, doc string")
    entries = needles.Cuts.of([prepared]).entries(F.col("doc"))
    left = {r["i"]: sorted(r["grams"]) for r in texts.select("i", F.transform(entries, lambda e: e["gram"]).alias("grams")).collect()}
    # of the names only anchors leave the scan; addresses are too many to be named in the plan
    assert [g for g in left[1] if "@" not in g] == ["Ada", "Ber"] and [g for g in left[2] if "@" not in g] == []
    found = {tuple(r) for r in needles.occurrences(texts, ["i"], ["doc"], prepared).collect()}
    assert found == {(1, "doc", "Ada"), (1, "doc", "Berg"), (1, "doc", "a7.b7@x.org")}


def test_broadcasts_are_bounded_by_the_drivers_heap(spark, monkeypatch):
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert broadcast_limit(spark) == min(session.DEFAULT_BROADCAST_BYTES, heap // session.HEAP_SHARE)
    monkeypatch.setattr(session, "HEAP_SHARE", 1000)
    assert broadcast_limit(spark) == heap // 1000
    spark.conf.set(BROADCAST_BYTES_CONF, "77")
    try:
        assert broadcast_limit(spark) == 77
    finally:
        spark.conf.unset(BROADCAST_BYTES_CONF)
