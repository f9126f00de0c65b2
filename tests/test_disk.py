"""What a query leaves on disk while it runs: files that nothing reads again go at once."""

import os

from pyspark.sql import functions as F

from sectionmap.plans import document as D
from sectionmap.queries import extracts as Q
from sectionmap.session import checkpoint_base, scratch_scope, staged
from sectionmap.sources import extracts as E
from sectionmap.sources import io as IO
from sectionmap.sources.fixtures import Inputs
from tests.conftest import SF001


def _kept(spark):
    return set(os.listdir(checkpoint_base(spark).removeprefix("file:")))


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle")}


def _trs(spark, n):
    return spark.range(n).select(F.col("id").cast("int").alias("ID"), F.lit("01N").alias("TOWNSHIP"), F.lit("1E").alias("RANGE"), F.lit(",1,").alias("SECTION"))


def test_shuffles_end_with_the_write(spark):
    before, conf = _shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    df = staged(_trs(spark, 5000).repartition(5, "ID").groupBy("SECTION", "ID").count(), "shuffled")
    assert not _shuffle_files(spark) - before and df.count() == 5000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == conf


def test_document_leaves_only_its_files(spark, tmp_path):
    kept, files = _kept(spark), _shuffle_files(spark)
    for compression in ("none", "gzip"):
        path = str(tmp_path / compression)
        D.write_document(spark, [D.trs_records(_trs(spark, 3000).orderBy(F.rand(1)))], path, "now", compression)
        assert _kept(spark) == kept and not _shuffle_files(spark) - files
        back = IO.read_raw_records(spark, path, "TRS", list(E.TRS_FIELDS)).orderBy(*IO.PLACE).collect()
        assert [int(r["ID"]) for r in back] == list(range(3000)) and {r["_unreadable"] for r in back} == {None}
        files = _shuffle_files(spark)


def test_extracts_are_packed_and_read_whole(spark, tmp_path):
    inp, root = Inputs(spark, SF001), str(tmp_path)
    for write in Q.ALL:
        write(inp, root)
    e = E.Extracts(spark, root)
    files = e.manifest().select("extract", F.col("path").endswith(".gz").alias("packed"), "length").where("length > 0").collect()
    # The bytes of the listings are a result; the other files are only read back.
    assert {r["extract"] for r in files if not r["packed"]} == {f"listing/{n}" for n in E.LISTINGS}
    assert sum(r["length"] for r in files if r["extract"] == "map.xml") < e.maps.good.count() * 100
    legacy = inp.f_legacy_map.select("id", "maptype", "descript", "recdate")
    read = e.f_legacy_map.select(*legacy.columns)
    assert legacy.exceptAll(read).count() == 0 and read.exceptAll(legacy).count() == 0
    assert e.trs.quarantine.count() == inp.f_bad_trs.count() and e.maps.quarantine.count() == inp.f_bad_map.count()
    assert e.f_cc.exceptAll(inp.f_cc.select(*e.f_cc.columns)).count() == 0 and e.f_cc.count() == inp.f_cc.count()


def test_repeated_keys_are_looked_for_once(spark, tmp_path):
    (tmp_path / "map.xml").mkdir()
    for name, ids in (("part-0", "1 2 x 2 3"), ("part-1", "3 4 1 x 1")):
        (tmp_path / "map.xml" / name).write_text("<dataroot>" + "".join(f"<map><ID>{i}</ID><BOOK>{k}</BOOK></map>" for k, i in enumerate(ids.split())) + "</dataroot>")
    kept = _kept(spark)
    with scratch_scope(spark):
        maps = E.Extracts(spark, str(tmp_path)).maps
        assert len(_kept(spark) - kept) == 1
        for df in maps:
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan and "Exchange" not in plan
        assert sorted((r["ID"], r["BOOK"]) for r in maps.good.collect()) == [(1, 0), (2, 1), (3, 4), (4, 1)]
        assert sorted((r["record_key"], r["reasons"]) for r in maps.quarantine.collect()) == [
            ("1", "repeated ID"), ("1", "repeated ID"), ("2", "repeated ID"), ("3", "repeated ID"), ("x", "bad ID"), ("x", "bad ID")]
    assert _kept(spark) == kept


def test_rebuild_keeps_no_table_that_it_has_read(spark, tmp_path, monkeypatch):
    from sectionmap.plans import publish as PB
    write, kept, seen = PB._write, _kept(spark), {}

    def spy(df, path, *args, **kw):
        seen[os.path.basename(path)] = {n.rsplit("-", 1)[0] for n in _kept(spark) - kept}
        return write(df, path, *args, **kw)

    monkeypatch.setattr(PB, "_write", spy)
    files = _shuffle_files(spark)
    assert PB.rebuild(spark, SF001, str(tmp_path))["published"]
    assert not _shuffle_files(spark) - files and _kept(spark) == kept
    assert seen["trs"] == {"trs"} and seen["trs_path"] == {"trs_path"} and seen["signed_by"] == set()


def test_parser_reads_the_records_of_eligible_maps(spark, monkeypatch):
    from sectionmap.plans import parser as P
    from sectionmap.plans import trs as TR
    from sectionmap.sources import constants as C
    maps = spark.createDataFrame([(1, 1, "NE/4 S6 & SE/4 S6"), (2, 1, "NE/4 S6"), (3, 2, "NE/4 S7")], "id int, maptype_id int, description string").select(
        "*", *[F.lit(None).cast("int").alias(c) for c in ("book", "page", "npages")], F.lit(None).cast("date").alias("recdate"), F.lit(None).cast("string").alias("client"))
    rows = [(1, 0, 1, 6, None, 0), (2, 0, 1, 6, None, 0), (3, 4, 1, 7, None, 0), (3, 4, 1, 7, None, 0), (None, 0, 1, 6, None, 0)]
    sections = spark.createDataFrame(rows, "map_id int, tshp int, rng int, sec int, subsec int, source_id int")
    qq = spark.createDataFrame([(2, 0, 1, 9, 5)], "map_id int, tshp int, rng int, sec int, subsec int")
    sheet = spark.createDataFrame([], "maptype string, book int, page int, trs string")
    read, parse = [], P.parsed_records
    monkeypatch.setattr(P, "parsed_records", lambda m, trs: read.append(trs) or parse(m, trs))
    built = TR.build_trs(sections, qq, sheet, maps, C.maptype(spark))
    assert sorted(r["map_id"] for r in read[0].collect()) == [1, 3, 3]
    base = [tuple(r) for r in built.collect()]
    assert [r for r in base if r[5] == 3] == [r for r in base if r[0] == 1 and r[4] is not None] and len(base) == 8


def test_matches_are_dealt_as_numbers(spark):
    from sectionmap.plans import parser as P
    rows = [(1, 0, 1, 6, None), (1, 0, 1, 6, 3), (1, 2, -1, 6, None), (1, 500, 1, 6, None), (1, 0, 1, None, None), (2, -1, 0, 36, None)]
    trs = spark.createDataFrame(rows, "map_id int, tshp int, rng int, sec int, subsec int")
    m = P.section_matches(trs, 4)
    dealt = [line for line in m._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate" in line or "RepartitionByExpression" in line]
    assert "t_txt" not in dealt[-1] and len([x for x in dealt if "Aggregate" in x]) == 2
    got = {(r["map_id"], r["s_txt"]): (r["n"], tuple(r["last"]), sorted(map(tuple, r["pairs"]))) for r in m.collect()}
    assert got == {(1, "S6"): (3, (2, -1, "3N", "1W"), [("1N", "2E"), ("3N", "1W")]), (2, "S36"): (1, (-1, 0, "1S", "1E"), [("1S", "1E")])}


def test_checks_take_one_entry_a_key(spark):
    from sectionmap.plans import checks as CK
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    maps = df([(1,), (2,), (2,), (None,), (None,)], "id int")
    tables = [df([("A",), ("B",), (None,)], "maptype string"), df([("A",)], "maptype string"), maps,
              df([(1, "x"), (2, "x"), (3, None)], "id int, fullname string"), df([("l", "x"), ("l", "z"), (None, None)], "legacy_name string, fullname string"),
              df([(1, 1), (1, 1), (9, 8), (None, 1)], "map_id int, surveyor_id int"), df([(1,), (9,), (9,), (None,)], "map_id int"),
              df([(1, 1), (2, 9), (3, None)], "cc_id int, map_id int"), df([(1,), (7,), (None,)], "cc_id int")]
    checks = CK.constraint_checks(*tables)
    assert {r["check"]: r["violations"] for r in checks.collect()} == {
        "unknown_maptype": 1, "map_pk": 2, "surveyor_fullname_unique": 1, "alias_unique": 1, "alias_fk_surveyor": 1, "signed_by_pk": 1,
        "signed_by_fk_map": 1, "signed_by_fk_surveyor": 1, "trs_fk_map": 2, "cc_fk_map": 1, "cc_image_fk_cc": 1}
    assert CK._entries(maps, CK._entry("map", "id", parent=True)).count() == 5
    assert {r["violations"] for r in CK.constraint_checks(*[t.where("1 = 0") for t in tables]).collect()} == {0}
