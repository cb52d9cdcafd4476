"""Star load: contract, keys, later loads, and increments from a stream."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from skyledger.catalog import inputs
from skyledger.operators import asof, seen
from skyledger.operators.evidence import added_up
from skyledger.plans import etl, history as h, memory, star
from skyledger.plans.clean import clean
from skyledger.schemas import FACT_COLUMNS
from skyledger.sources import files
from skyledger.sources.warehouse import Warehouse
from skyledger.streaming import increments

SF = "/root/testdata/sf0.001"


def cleaner(spark):
    def run(raw, area, known=None):
        return clean(raw, inputs.lookup(spark, SF, "airports"), inputs.lookup(spark, SF, "history"), area, memory=known)

    return run


def first_load(spark, raw, target, load_date, area):
    return etl.first_load(raw, target, load_date, area, lambda *args: area.table(cleaner(spark)(*args), "clean"))


def test_contract_names_every_reason(spark):
    rows = [(1, 1, "Invierno", 2000), (2, 13, None, 1980), (3, None, "x" * 21, 2000)]
    df = spark.createDataFrame(rows, "TiempoKey int, Mes int, Estacion string, Anio int")
    accepted, rejected = star.dw_contract("Tiempo", df)
    assert [r.TiempoKey for r in accepted.collect()] == [1]
    reasons = {r.TiempoKey: r.reasons for r in rejected.collect()}
    assert reasons == {2: ["Estacion is null", "Mes outside 1-12", "Anio outside 1990-2100"],
                       3: ["Mes is null", "Estacion too long"]}


def test_star_invariants(spark, area):
    cleaned = area.table(cleaner(spark)(inputs.segments(spark, SF), area), "clean")
    built = star.build_star(cleaned, "2024-01-15", area)
    fact = built["Vuelo"]
    n = cleaned.count()
    assert fact.count() == n
    assert fact.agg(F.min("VueloKey"), F.max("VueloKey"), F.count_distinct("VueloKey")).first()[:] == (1, n, n)
    assert star.orphans(fact, built).count() == 0
    for table, key in star.NATURAL_KEYS.items():
        assert star.duplicate_keys(built[table], *key).count() == 0
    again = star.build_star(cleaned.repartition(3), "2024-01-15", area)
    assert fact.exceptAll(again["Vuelo"]).count() == 0


def test_scd2_closes_and_adds(spark, area):
    current = spark.createDataFrame(
        [(1, "A", "g1", "r", date(2024, 1, 1), None, True), (2, "B", "g", "r", date(2024, 1, 1), None, True)],
        "TransportistaKey int, CarrierNombre string, CarrierGrupo string, Region string, Fecha_Inicio date, Fecha_Fin date, Fila_Activa boolean")
    new = spark.createDataFrame([("A", None, "r"), ("B", "g", "r"), ("C", "n", "r")],
                                "CarrierNombre string, CarrierGrupo string, Region string")
    args = (["CarrierNombre"], ["CarrierGrupo", "Region"], "TransportistaKey", "2024-02-15", area)
    after = h.scd2(current, new, *args)
    got = {r.TransportistaKey: (r.CarrierNombre, r.CarrierGrupo, r.Fecha_Fin, r.Fila_Activa) for r in after.collect()}
    assert got == {1: ("A", "g1", date(2024, 2, 14), False), 2: ("B", "g", None, True),
                   3: ("A", None, None, True), 4: ("C", "n", None, True)}
    assert h.scd2(after, new, *args).exceptAll(after).count() == 0


def test_csv_scan_and_missing_lookup(spark, area):
    folder = area.path("csv").removeprefix("file:")
    import os

    os.makedirs(folder)
    with open(f"{folder}/l_strport.csv", "w", encoding="utf-8") as f:
        f.write('Code,Description\nATL,"Atlanta, GA: The ""Big"" One"\nNA,None\nX, \n')
    found = files.scan_lookups(spark, folder, area=area)
    assert list(found) == ["stg_airports"]
    assert [tuple(r) for r in found["stg_airports"].orderBy("row_id").select("Code", "Description").collect()] == [
        ("ATL", 'Atlanta, GA: The "Big" One'), (None, None), ("X", " ")]


def test_stream_increments_load_once(spark, area):
    raw = inputs.segments(spark, SF)
    target, inbox, progress = area.path("dw"), area.path("inbox"), area.path("progress")
    first_load(spark, raw.where("Year < 1998"), target, "2024-01-15", area)
    house = Warehouse(spark, target)
    n = house.read("Vuelo").count()

    raw.where("Year >= 1998").write.parquet(inbox)
    for _ in range(2):  # the second start finds nothing new
        increments.start(spark, inbox, target, progress, "2024-02-15", cleaner(spark)).awaitTermination()
    facts = house.read("Vuelo")
    total = facts.count()
    assert total > n
    assert facts.agg(F.max("VueloKey"), F.count_distinct("VueloKey")).first()[:] == (total, total)
    assert house.read(increments.LOG).count() == 8
    batch = house.read(increments.LEDGER).first()["lote"]
    increments.load_batch(raw.where("Year >= 1998"), batch, target, "2024-02-15", cleaner(spark))
    assert house.read("Vuelo").count() == total
    dims = {t: house.read(t) for t in increments.DIMENSIONS}
    assert star.orphans(facts, dims).count() == 0


def test_changing_members_in_a_batch(spark, area):
    """Type 2: a changed member gets a version, and facts the one that was valid in their month; type 1 overwrites."""
    raw = inputs.segments(spark, SF).where("row_id % 5 = 0")
    target = area.path("dw")
    first_load(spark, raw.where("Year < 1996"), target, "1996-01-15", area)
    later = raw.where("Year between 1996 and 1997").withColumns({
        "CarrierGroupNew": F.when(F.col("AirlineID") % 2 == 0, F.lit("X")).otherwise(F.col("CarrierGroupNew")),
        "OriginCountryName": F.lit("Elsewhere"),
    })
    changing = {"Transportista": 2, "Aeropuerto": 1}
    for _ in range(2):
        increments.load_batch(later, "2", target, "1997-01-01", cleaner(spark), changing=changing)
    house = Warehouse(spark, target)
    carriers, airports = house.read("Transportista"), house.read("Aeropuerto")
    versions = {}
    for r in carriers.orderBy("TransportistaKey").collect():
        versions.setdefault(r.CarrierNombre, []).append(r)
    changed = {name: v for name, v in versions.items() if len(v) == 2}
    assert changed and all([v.Fila_Activa for v in vs] == [False, True] and str(vs[0].Fecha_Fin) == "1996-12-31" and
                           str(vs[1].Fecha_Inicio) == "1997-01-01" for vs in changed.values())
    assert airports.where("Pais = 'Elsewhere'").count() > 0
    assert airports.groupBy("Nombre").count().where("count > 1").count() == 0
    facts = house.read("Vuelo").where("lote = '2'").join(carriers, "TransportistaKey")
    years = {(r.CarrierNombre, r.Anio, r.TransportistaKey) for r in facts.select("CarrierNombre", "Anio", "TransportistaKey").distinct().collect()}
    for name, vs in changed.items():
        assert {k for n, y, k in years if n == name and y == 1996} <= {vs[0].TransportistaKey}
        assert {k for n, y, k in years if n == name and y == 1997} <= {vs[1].TransportistaKey}
    assert {y for n, y, k in years if n in changed} == {1996, 1997}
    assert star.orphans(house.read("Vuelo"), {t: house.read(t) for t in increments.DIMENSIONS}).count() == 0


def test_as_of_equals_brute_force(spark, area):
    rnd = random.Random(7)
    day = lambda: date(2000, 1, 1) + timedelta(rnd.randrange(1200))
    versions = []
    for key in (None, "a", "b", "c"):
        starts = sorted({day() for _ in range(6)})
        for i, start in enumerate(starts):
            end = starts[i + 1] - timedelta(1) if i + 1 < len(starts) else rnd.choice([None, start + timedelta(90)])
            versions.append((key, start, end, len(versions)))
    versions += [("d", None, None, 100), ("e", date(2001, 5, 5), None, 102), ("e", date(2001, 5, 5), None, 101)]
    points = [(rnd.choice([None, "a", "b", "c", "d", "e", "f"]), day()) for _ in range(800)] + [("a", None), (None, None)]
    points += [(k, s) for k, s, _, _ in versions] + points[:20]
    held = spark.createDataFrame(versions, "k string, since date, until date, v int")
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, k string, at date").repartition(3)

    def valid(key, at):
        begun = [v for v in versions if v[0] == key and at and (v[1] is None or v[1] <= at)]
        last = max(begun, key=lambda v: (v[1] or date.min, v[3]), default=None)
        return last[3] if last and (last[2] is None or last[2] >= at) else None

    for unit in ("year", "month"):
        found = asof.as_of(df, held, ["k"], "at", "since", "until", "v", unit)
        got = {(r.k, r["at"]): r.v for r in found.collect()}
        assert got == {p: valid(*p) for p in points}
    joined = asof.attach_as_of(df, held, ["k"], "at", "since", "until", "v", area)
    assert [r.v for r in joined.orderBy("i").collect()] == [valid(*p) for p in points]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_contract_tells_overflow_from_missing(spark):
    df = spark.createDataFrame([(1, 25.0, "S"), (2, None, "S"), (3, 0.5, None)], "VueloKey long, OcupPasajeros double, tipoServicio string")
    required = [c for c, _, need in star.STAR["Vuelo"] if need and c not in df.columns]
    df = df.withColumns({c: F.lit(1) for c in required}).withColumn("OcupCarga", F.lit(0.1))
    accepted, rejected = star.dw_contract("Vuelo", df)
    assert [r.VueloKey for r in accepted.collect()] == [2]
    assert {r.VueloKey: r.reasons for r in rejected.collect()} == {1: ["OcupPasajeros does not fit"], 3: ["tipoServicio is null"]}


def test_repeated_members_are_refused(spark):
    dim = spark.createDataFrame([(1, 5, "Verano", 2000), (2, 5, "Otro", 2000), (3, 6, "Verano", 2000)], "TiempoKey int, Mes int, Estacion string, Anio int")
    accepted, rejected = star.dw_contract("Tiempo", dim)
    assert sorted(r.TiempoKey for r in accepted.collect()) == [1, 3]
    assert [r.reasons for r in rejected.collect()] == [["repeated Anio, Mes"]]


def test_feeds_with_repeated_keys(spark, area):
    current = spark.createDataFrame(
        [(1, "A", "g1", "r", date(2024, 2, 15), None, True)],
        "TransportistaKey int, CarrierNombre string, CarrierGrupo string, Region string, Fecha_Inicio date, Fecha_Fin date, Fila_Activa boolean")
    feed = spark.createDataFrame([("A", "g2", "r"), ("A", "g3", "a"), ("B", None, "r"), ("B", "x", None)],
                                 "CarrierNombre string, CarrierGrupo string, Region string")
    key, attributes = ["CarrierNombre"], ["CarrierGrupo", "Region"]
    last = {"A": ("g3", "a"), "B": ("x", None)}
    assert {r[0]: (r[1], r[2]) for r in h.one_per_key(feed, key).collect()} == last
    assert sorted(map(tuple, h.change_detect(current, feed, key, attributes).collect())) == [("A", "changed"), ("B", "new")]
    assert sorted(r.CarrierNombre for r in h.upsert(feed.limit(0), feed, key).collect()) == ["A", "B"]
    plain = current.select("TransportistaKey", *key, *attributes)
    assert {tuple(r) for r in h.scd1(plain, feed, key, attributes, "TransportistaKey", area).collect()} == {(1, "A", "g3", "a"), (2, "B", "x", None)}
    after = h.scd2(current, feed, key, attributes, "TransportistaKey", "2024-02-15", area).collect()
    assert sorted((r.CarrierNombre, r.CarrierGrupo, r.Fecha_Fin, r.Fila_Activa) for r in after if r.CarrierNombre == "A") == [
        ("A", "g1", date(2024, 2, 15), False), ("A", "g3", None, True)]
    assert len(after) == 3
    assert [r.CarrierGrupo_anterior for r in h.scd3(plain, feed, key, "CarrierGrupo").collect()] == ["g1"]


def test_null_members_are_added_once(spark, area):
    dim = spark.createDataFrame([(1, None, None, None)], "AeropuertoKey int, Nombre string, Ciudad string, Pais string")
    members = spark.createDataFrame([(None, None, None), ("X", None, None)], "Nombre string, Ciudad string, Pais string")
    assert sorted(map(tuple, h.add_members(dim, members, "Aeropuerto", "2024-01-15", area).collect()), key=str) == [
        (1, None, None, None), (2, "X", None, None)]


def test_rows_keep_the_order_of_their_files(spark, area):
    import os

    folder = area.path("csv").removeprefix("file:")
    os.makedirs(folder)
    expected = []
    for name, rows in (("part-a", 3), ("part-b", 4000), ("part-c", 40), ("part-d", 900)):
        lines = [f"{name}-{i},{'x' * (i % 60)}" for i in range(rows)]
        expected += [line.split(",")[0] for line in lines]
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as f:
            f.write("\n".join(["Code,Description", *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "16384", "40000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            read = area.table(files.scan_lookup_csv(spark, folder, area), "read")
            assert [r.Code for r in read.orderBy("row_id").collect()] == expected
            assert read.select("row_id").distinct().count() == len(expected)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_of_earlier_loads_are_not_loaded_again(spark, area):
    """Only suspects' buckets of the digests are read; a row that differs in a null is another row."""
    raw = inputs.segments(spark, SF).where("row_id % 5 = 0")
    target = area.path("dw")
    first_load(spark, raw.where("Year < 1996"), target, "2024-01-15", area)
    house = Warehouse(spark, target)
    n, digests = house.read("Vuelo").count(), house.read(memory.DIGESTS).count()
    assert digests == raw.where("Year < 1996").drop("row_id").distinct().count()
    again = raw.where("Year < 1996").withColumn("row_id", F.col("row_id") + 7)
    increments.load_batch(again, "again", target, "2024-02-15", cleaner(spark), copies=True)
    assert (house.read("Vuelo").count(), house.read(memory.DIGESTS).count()) == (n, digests)
    changed = again.limit(3).withColumn("Mail", F.lit(None).cast("double"))
    load = house.begin()
    assert memory.new_rows(load, again.unionByName(changed), area).count() == changed.count()
    bits = seen.filters(area.table(seen.digests(seen.digested(raw, FACT_COLUMNS)), "own"))
    other = seen.digests(seen.digested(raw.withColumn("Mail", F.lit(5.5)), FACT_COLUMNS))
    assert seen.maybe_known(other, bits).count() < 0.2 * other.count()


def test_evidence_of_two_loads_adds_up(spark, area):
    """A batch that knows nothing itself fills its gaps from the load before; only its own counters are written."""
    raw = inputs.segments(spark, SF).where("row_id % 5 = 0")
    target = area.path("dw")
    first_load(spark, raw, target, "2024-01-15", area)
    house = Warehouse(spark, target)
    before = house.manifest()["tables"][memory.EVIDENCE]["folders"]
    blind = raw.where("Class IS NOT NULL AND trim(Class) <> ''").limit(40).withColumns({"Class": F.lit(None).cast("string"), "row_id": F.col("row_id") + 10**6})
    increments.load_batch(blind, "2", target, "2024-02-15", cleaner(spark), evidence=True)
    facts = house.read("Vuelo").where("lote = '2'")
    assert facts.count() > 0 and facts.where("tipoServicio IS NULL").count() == 0
    after = house.manifest()["tables"][memory.EVIDENCE]["folders"]
    assert after[:len(before)] == before and len(after) == len(before) + 1
    stored = house.read(memory.EVIDENCE)
    assert stored.where("_load = 2").count() < stored.where("_load = 1").count()
    summed = {(r.name, r.key1, r.key2, r.value): (r._n, r._w) for r in added_up(stored).collect()}
    for r in stored.groupBy("name", "key1", "key2", "value").agg(F.sum("_n").alias("n"), F.sum("_w").alias("w")).collect():
        assert summed[r.name, r.key1, r.key2, r.value] == (r.n, r.w)
