"""From CSV files to the star, twice."""

import os

import pytest
from pyspark.sql import functions as F

from skyledger import fixed_values as fv
from skyledger.catalog import inputs
from skyledger.catalog.queries import _write_csv
from skyledger.plans import etl, history, star
from skyledger.plans.clean import clean
from skyledger.schemas import LOOKUP, STAR
from skyledger.sources import files, warehouse
from skyledger.sources.warehouse import Warehouse
from skyledger.streaming import increments

SF = "/root/testdata/sf0.001"


def test_whole_run_is_repeatable(spark, area):
    source, staging, target = (area.path(n) for n in ("source", "staging", "dw"))
    _write_csv(inputs.segments(spark, SF).drop("row_id").coalesce(1), f"{source}/{fv.FACT_FILE}")
    _write_csv(inputs.lookup(spark, SF, "airports").drop("row_id"), f"{source}/l_strport.csv")
    first = {r.tabla: r.filas for r in etl.run(spark, source, staging, target, "2024-01-15").collect()}
    facts = Warehouse(spark, target).read("Vuelo")
    assert first["Vuelo"] == facts.count() == spark.read.parquet(f"{staging}/{fv.CLEAN_TABLE}").count()
    assert set(facts.columns) == {c for c, _, _ in STAR["Vuelo"]} | {"Anio", "lote"}
    before = area.table(facts, "before")
    second = {r.tabla: r.filas for r in etl.run(spark, source, staging, target, "2024-01-15").collect()}
    assert second == first
    assert Warehouse(spark, target).read("Vuelo").exceptAll(before).count() == 0
    house, n = Warehouse(spark, target), before.count()
    house.sweep(keep=1)  # only the folders of the last load are left
    assert spark.read.parquet(f"{target}/Vuelo").count() == n == house.read("Vuelo").count()


def test_full_run_then_increments(spark, area):
    """Increments on the warehouse that the run wrote: CSV files, a replay, and a failure before the facts."""
    source, staging, target, inbox = (area.path(n) for n in ("source", "staging", "dw", "inbox"))
    raw = inputs.segments(spark, SF)
    raw = raw.withColumn("Month", F.when(F.col("row_id") % 40 == 3, 13).otherwise(F.col("Month")))
    _write_csv(raw.where("Year < 1998").drop("row_id"), f"{source}/{fv.FACT_FILE}")
    _write_csv(inputs.lookup(spark, SF, "airports").drop("row_id"), f"{source}/l_strport.csv")
    log = etl.run(spark, source, staging, target, "2024-01-15").collect()
    loaded = {r.tabla: r for r in log if r.estado == "cargada"}
    assert "stg_carrier_history" in {r.tabla for r in log if r.estado == "ausente"}
    cleaned = spark.read.parquet(f"{staging}/{fv.CLEAN_TABLE}").count()
    assert loaded["Vuelo"].rechazadas > 0 and loaded["Vuelo"].filas + loaded["Vuelo"].rechazadas == cleaned
    assert loaded["Tiempo"].rechazadas > 0
    reasons = {m for r in star.read_rejects(spark, target).collect() for m in r.motivos}
    assert {"Mes outside 1-12", "TiempoKey is null"} <= reasons

    def warehouse_rows():
        house = Warehouse(spark, target)
        dims = {t: house.read(t) for t in increments.DIMENSIONS}
        facts = house.read("Vuelo")
        assert star.orphans(facts, dims).count() == 0
        for table, key in star.NATURAL_KEYS.items():
            assert star.duplicate_keys(dims[table], *key).count() == 0
        n = facts.count()
        assert facts.agg(F.count_distinct("VueloKey")).first()[0] == n
        return n

    first = warehouse_rows()
    cleaner = lambda df, a: clean(df, inputs.lookup(spark, SF, "airports"), inputs.lookup(spark, SF, "history"), a)
    _write_csv(raw.where("Year >= 1998").drop("row_id").repartition(3), inbox)
    whole = history.load_log

    def fails(*args, **kwargs):
        raise RuntimeError("before the log")

    paths = [f.path for f in spark.read.format("binaryFile").load(inbox).select("path").collect()]
    increments.history.load_log = fails
    try:
        with pytest.raises(RuntimeError):
            increments.load_files(spark, paths, target, "2024-02-15", cleaner, "b'2")
    finally:
        increments.history.load_log = whole
    assert warehouse_rows() == first
    house = Warehouse(spark, target)
    for _ in range(2):
        increments.load_files(spark, paths, target, "2024-02-15", cleaner, "b'2")
    assert warehouse_rows() > first
    assert house.read("CargaLog").where(F.col("lote") == "b'2").count() == 4
    # What is known is the files: a stream with progress of its own finds nothing new, and one more file is not skipped.
    total = warehouse_rows()
    for progress in ("progress-1", "progress-2"):
        increments.start(spark, inbox, target, area.path(progress), "2024-03-15", cleaner).awaitTermination()
        assert warehouse_rows() == total
    second = area.path("second-inbox")
    _write_csv(raw.where("Year = 1997").limit(20).drop("row_id").coalesce(1), second)
    increments.start(spark, second, target, area.path("progress-3"), "2024-03-15", cleaner).awaitTermination()
    assert warehouse_rows() > total
    assert house.read(increments.LEDGER).count() == len(paths) + 1


def test_a_load_that_fails_leaves_the_star_as_it_was(spark, area):
    """After the first and the last write of a reload and of an increment, and between them."""
    target = area.path("dw")
    raw = inputs.segments(spark, SF).where("row_id % 7 = 0")
    cleaner = lambda df, a, k=None: clean(df, inputs.lookup(spark, SF, "airports"), inputs.lookup(spark, SF, "history"), a, memory=k)
    written = lambda *args: area.table(cleaner(*args), "clean")
    etl.first_load(raw.where("Year < 1996"), target, "2024-01-15", area, written)
    house = Warehouse(spark, target)
    seen = lambda: {t: sorted(map(str, house.read(t).collect())) for t in (*increments.DIMENSIONS, "Vuelo", "CargaLog")}
    before, write = seen(), warehouse.Load._write

    def failing_at(n):
        def fails(self, *args):
            failing_at.writes += 1
            path = write(self, *args)
            if failing_at.writes == n:
                raise RuntimeError("lost")
            return path

        failing_at.writes = 0
        return fails

    loads = {
        "reload": (9, lambda: etl.first_load(raw, target, "2024-02-15", area, written)),
        "increment": (6, lambda: increments.load_batch(raw.where("Year >= 1996"), "2", target, "2024-02-15", cleaner)),
    }
    for kind, (writes, load) in loads.items():
        for n in ((1, 4, 6, writes) if kind == "reload" else (2, writes)):
            warehouse.Load._write = failing_at(n)
            try:
                with pytest.raises(RuntimeError, match="lost"):
                    load()
            finally:
                warehouse.Load._write = write
            assert seen() == before
    two = house.begin(), house.begin()
    two[0].commit()
    with pytest.raises(RuntimeError, match="another run"):
        two[1].commit()


def test_columns_by_name_and_lines_that_do_not_fit(spark, area):
    folder = area.path("csv")
    place = folder.removeprefix("file:")
    os.makedirs(place)
    written = {
        "a.csv": "Code,Description\n1,one\n2,two,surplus\n3\n\n4,\"fo,ur\"\n",
        "b.csv": "\ufeffDescription, Extra ,Code\r\nfive,x,5\r\nsix,y\r\n",
        "c.csv": "Code\n7\n8,8\n",
        "d.csv": "Description,Code,Description\nnine,9,again\n",
        "e.csv": "",
        "f.csv": "Code,Description\n",
    }
    for name, text in written.items():
        with open(f"{place}/{name}", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    for staged in (None, area):
        scan = files.scan_csv(spark, folder, LOOKUP, staged)
        rows = scan.rows.orderBy("row_id") if staged else scan.rows
        got = [(r.Code, r.Description) for r in rows.collect()]
        want = [("1", "one"), ("4", "fo,ur"), ("5", "five"), ("7", None), ("9", "nine")]
        assert (got if staged else sorted(got, key=str)) == want
        refused = {(r.archivo.rsplit("/", 1)[1], r.linea) for r in scan.refused.collect()} if staged else None
        assert refused is None or refused == {("a.csv", "2,two,surplus"), ("a.csv", "3"), ("b.csv", "six,y"), ("c.csv", "8,8")}
    with open(f"{place}/g.csv", "w", encoding="utf-8") as f:
        f.write("Other,Names\n1,2\n")
    with pytest.raises(ValueError, match="g.csv"):
        files.scan_csv(spark, folder, LOOKUP)
    quoted = area.path("quoted.csv")
    with open(quoted.removeprefix("file:"), "w", encoding="utf-8") as f:
        f.write('Code,Description\n1,"two\nlines"\n2,"a ""b"""\n')
    assert [tuple(r) for r in files.scan_csv(spark, quoted, LOOKUP, area, multi_line=True).rows.orderBy("row_id").select("Code", "Description").collect()] == [
        ("1", "two\nlines"), ("2", 'a "b"')]
    split = files.scan_csv(spark, quoted, LOOKUP, area)
    assert split.rows.count() + split.refused.count() == 3 and split.refused.count() == 2


def test_refused_lines_are_kept_by_the_load(spark, area):
    source, staging, target = (area.path(n) for n in ("source", "staging", "dw"))
    rows = inputs.segments(spark, SF).where("row_id % 9 = 0").drop("row_id")
    _write_csv(rows.coalesce(1), f"{source}/{fv.FACT_FILE}")
    with open(f"{source}/{fv.FACT_FILE}/z.csv".removeprefix("file:"), "w", encoding="utf-8") as f:
        f.write("Month,Year\n1,1999,3\n")
    log = {r.tabla: r for r in etl.run(spark, source, staging, target, "2024-01-15").collect()}
    assert (log[fv.FACT_TABLE].rechazadas, log[fv.FACT_TABLE].estado) == (1, "rechazada")
    kept = star.read_rejects(spark, target).where(F.col("tabla") == fv.FACT_TABLE).collect()
    assert [(r.motivos, '"linea":"1,1999,3"' in r.fila) for r in kept] == [([files.WRONG_LINE], True)]
