"""A delimited read parses whole rows without keeping a copy of them."""
import os

from vitrine import session
from vitrine.sources import delimited as D


def folders(spark) -> set[str]:
    top = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    return {os.path.join(a, x) for a, d, _ in os.walk(top) for x in d if x.startswith("rdd-")}


def test_delimited_read_keeps_no_parsed_copy(spark, tmp_path):
    p, q = tmp_path / "in.csv", tmp_path / "more.csv"
    p.write_text("a;b;c\n1;2;x\nbad;5;y\n3;bad;z\n")
    q.write_text("a;b;c\n4;5;w\n6;7\n")
    before = folders(spark)
    good, bad = D.read_delimited(spark, [str(p), str(q)], spark.createDataFrame([], "a int, b int, c string").schema)
    assert folders(spark) == before
    # a row is bad whichever columns a query reads
    assert good.count() == 2 and bad.count() == 3
    assert sorted(r.c for r in good.select("c").collect()) == ["w", "x"]
    assert good.where("b = 2").select("a").collect()[0].a == 1
    assert sorted(r[0] for r in bad.collect()) == ["3;bad;z", "6;7", "bad;5;y"]
