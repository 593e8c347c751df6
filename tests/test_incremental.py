"""Keys that stay over loads, and a base of which only changed days are built."""
import datetime as dt
import random

from pyspark.sql import functions as F

from vitrine.operators import registry as K
from vitrine.operators import silver as S
from vitrine.sinks import incremental as I
from vitrine.sinks import writers as Wr


def names(spark, *values):
    return spark.createDataFrame([(v, "x") for v in values], "nome string, outro string")


def keys(df):
    return {r.nome: (r.sk, r.carga) for r in df.collect()}


def test_keys_stay_and_have_no_gaps(spark, tmp_path):
    folder = str(tmp_path / "keys")
    first = keys(K.register_keys(names(spark, "d", "b", "b", None), folder, ["nome"], "sk"))
    assert first == {None: (1, 1), "b": (2, 1), "d": (3, 1)}
    second = keys(K.register_keys(names(spark, "a", "d", "c", None), folder, ["nome"], "sk"))
    assert second == first | {"a": (4, 2), "c": (5, 2)}
    assert keys(K.register_keys(names(spark, "a", "b"), folder, ["nome"], "sk")) == second
    assert keys(K.register_keys(names(spark, "0"), folder, ["nome"], "sk")) == second | {"0": (6, 3)}


def test_a_load_that_fails_before_its_marker_leaves_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "keys")
    first = keys(K.register_keys(names(spark, "b"), folder, ["nome"], "sk"))
    real, Wr_publish = Wr.publish, []
    monkeypatch.setattr(Wr, "publish", lambda *a: Wr_publish.append(a) or (_ for _ in ()).throw(OSError("lost")))
    try:
        K.register_keys(names(spark, "z", "a"), folder, ["nome"], "sk")
    except OSError:
        pass
    monkeypatch.setattr(Wr, "publish", real)
    assert Wr_publish and keys(K.read_register(
        spark, folder, K.T.StructType.fromDDL("sk long, nome string, carga int"))) == first
    assert keys(K.register_keys(names(spark, "c"), folder, ["nome"], "sk")) == first | {"c": (2, 2)}


def test_random_loads_keep_every_key(spark, tmp_path):
    rnd, folder, held = random.Random(1), str(tmp_path / "keys"), {}
    for _ in range(3):
        got = keys(K.register_keys(names(spark, *[f"n{rnd.randrange(60)}" for _ in range(40)]), folder, ["nome"], "sk"))
        assert held.items() <= got.items()
        held = got
    assert sorted(k for k, _ in held.values()) == list(range(1, len(held) + 1))


def drop(spark, rows):
    return spark.createDataFrame(rows, "data date, id string, v int")


def day(n):
    return dt.date(2026, 1, n)


def files(spark, base):
    return {r.f.split("/dia=")[1] for r in I.read_days(spark, base).select(F.input_file_name().alias("f"))
            .distinct().collect()}


def test_only_changed_days_are_built(spark, tmp_path):
    base, seen = str(tmp_path / "base"), []

    def build(rows):
        seen.append({str(r.data) for r in rows.select("data").distinct().collect()})
        return S.dedup_first(rows, ["data", "id"], [F.col("v").desc_nulls_last()])

    rows = [(day(n), i, v) for n in (1, 2, 3) for i in "ab" for v in (1, 2)] + [(None, "a", 1)]
    assert I.refresh_days(drop(spark, rows), base, build) == (1, ["2026-01-01", "2026-01-02", "2026-01-03", "sem-data"])
    before = files(spark, base)
    shuffled = drop(spark, rows[::-1]).repartition(5)  # the same content in another order
    assert I.refresh_days(shuffled, base, build) == (2, []) and files(spark, base) == before
    # day 2 has a row twice more, day 3 is gone, day 4 is new, day 1 and the rows without a day stay
    new = [r for r in rows if r[0] != day(3)] + [(day(2), "a", 2), (day(4), None, None)]
    assert I.refresh_days(drop(spark, new), base, build) == (3, ["2026-01-02", "2026-01-04"])
    assert seen[1:] == [{"2026-01-02", "2026-01-04"}]
    stay = {f for f in before if f.startswith(("2026-01-01", "sem-data"))}
    assert stay <= files(spark, base)
    got = sorted(map(tuple, I.read_days(spark, base).collect()), key=repr)
    want = S.dedup_first(drop(spark, new), ["data", "id"], [F.col("v").desc_nulls_last()])
    assert got == sorted(map(tuple, want.collect()), key=repr)
    assert {r.data for r in I.read_days(spark, base, 1).collect()} == {day(1), day(2), day(3), None}


def test_sums_tell_nulls_and_repeats_apart(spark):
    def sums(*rows):
        return I.content_sums(drop(spark, [(day(1), *r) for r in rows]), "data").collect()

    assert sums(("a", None)) != sums((None, 1)) and sums(("a", 1), ("a", 1)) != sums(("a", 1))
    assert sums(("a", 1), ("b", 2)) == sums(("b", 2), ("a", 1)) != sums(("a", 2), ("b", 1))


def test_rows_are_built_once_and_a_large_day_is_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "TASK_ROWS", 50)
    rows = spark.range(400).selectExpr("date'2024-01-01' + cast(id >= 300 AS int) AS data", "id AS v")
    seen = spark.sparkContext.accumulator(0)

    def build(drop):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch
        return drop.mapInArrow(count, drop.schema)

    base = str(tmp_path / "base")
    joined = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(joined)
    spark.conf.set(joined, "false")  # so small parts would be put together
    try:
        I.refresh_days(rows, base, build)
    finally:
        spark.conf.set(joined, old)
    assert seen.value == 400  # no second run of the plan for the bounds of ranges
    assert sorted(r.v for r in I.read_days(spark, base).collect()) == [*range(400)]
    assert len(list((tmp_path / "base/dias/v000001/dia=2024-01-01").glob("*.parquet"))) > 1
