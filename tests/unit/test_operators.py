"""Entity operators on small tables."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from potsherd.operators import harmonise, hierarchy, keys, merge, outline, references, reports, search, views, writes
from potsherd.sources import staging, tables


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_routing_and_inheritance(spark):
    data = "table string, projectcd string, _seq long, data map<string,string>"
    df = spark.createDataFrame([("PUTTEN", "DC1", 1, {"a": "1"}), ("putten_oud", "DC1", 2, {"b": "2"}), ("SPOREN", "DC1", 3, {"c": "x"})], data)
    base = harmonise.Entity("Base", (), attributes={"nr": ("a", "b"), "name": ("c",)})
    put = harmonise.Entity("Put", ("put",), ("oud",), {"name": "vast"}, base)
    glas = harmonise.Entity("Glas", ("spo",), attributes={"nr": ("c",)}, artefact=True)
    assert rows(harmonise.store(df, [put, glas]), "soort", "artefactsoort", "nr", "name") == [("Artefact", "Glas", "x", None), ("Put", None, "1", "vast")]
    assert harmonise.harmonised(df, harmonise.Entity("Leeg", ())).count() == 0


def test_sentinels(spark):
    df = spark.createDataFrame([("-", float("nan"), {"a": "Unknown", "b": "x"}), ("y", 1.0, None)], "s string, d double, m map<string,string>")
    assert rows(harmonise.without_sentinels(df)) == sorted([(None, None, {"b": "x"}), ("y", 1.0, None)], key=str)


def test_keys(spark):
    df = spark.createDataFrame([("DC001", 3, 7, False), ("DC001", 3, 7, True), ("DC001", None, 7, False), (None, 3, 7, False), ("DC001", None, 7, True)], "projectcd string, putnr long, vondstnr long, vondstkey_met_putnr boolean")
    out = keys.with_keys(df, {"key": "P:projectcd vondstkey_met_putnr?P:putnr V:vondstnr", "spoor": "P:projectcd [P:putnr] [V:vlaknr] S:vondstnr"})
    assert [(r.key, r.spoor) for r in out.collect()] == [("PDC001V7", "PDC001P3S7"), ("PDC001P3V7", "PDC001P3S7"), ("PDC001V7", "PDC001S7"), (None, None), (None, "PDC001S7")]
    older = keys.with_keys(df.withColumn("key", F.lit("oud")), {"key": "P:projectcd"})
    assert {r.key for r in older.collect()} == {"PDC001", "oud"}


def test_surrogates(spark):
    df = spark.createDataFrame([("A", k, f"i{k}") for k in range(100)] + [("B", 5, "x"), ("B", 5, "y"), (None, 1, "z")], "soort string, _seq long, _id string").repartition(5)
    got = {(r.soort, r._id): r.ID for r in keys.with_surrogates(df).collect()}
    assert got == {("A", f"i{k}"): k for k in range(100)} | {("B", "x"): 0, ("B", "y"): 1, (None, "z"): 0}


def test_merge(spark):
    schema = "key string, soort string, a string, n long, _seq long, table string, brondata map<string,string>"
    df = spark.createDataFrame(
        [("k", "S", "x", None, 1, "T1", {"p": "1"}), ("k", "S", None, 5, 2, "T2", {"p": "2"}), ("k", "S", "y", None, 3, "T2", {"p": "2"}), (None, "S", "z", 1, 4, "T3", {"p": "3"}), (None, "S", "w", 2, 5, "T3", None)], schema
    )
    out = merge.merge_duplicates(df, ["key"], "_seq", ["table"], "brondata")
    got = sorted(((r.key, r.a, r.n, [w.table for w in r.lineage], r.brondata, r.brondata_count) for r in out.collect()), key=str)
    assert got == sorted([("k", "y", 5, ["T1", "T2"], [{"p": "1"}, {"p": "2"}], 2), (None, "z", 1, ["T3"], [{"p": "3"}], 1), (None, "w", 2, ["T3"], [], 0)], key=str)
    assert merge.merge_duplicates(df, ["key"], "_seq", null_keys=True).count() == 2
    again = merge.merge_duplicates(out.select("key", "soort", "a", "n", "_seq"), ["key"])
    assert rows(again, "key", "a", "n") == rows(out, "key", "a", "n")


def test_move_and_merge_part_the_rows(spark):
    df = spark.createDataFrame([("1", "X", "DC1"), (None, "X", "DC1"), ("1", "ARTEFACT", "DC1"), ("1", "ROMEINS AARDEWERK", "DC1"), ("1", "X", "DC112")], "subnr string, table string, projectcd string")
    how = (["ROMEINS AARDEWERK"], ["DC112"])
    assert df.where(merge.to_merge(*how)).count() == 1
    assert df.where(merge.to_move(*how)).count() == 3


def test_missing(spark):
    seen = spark.createDataFrame([("DC1", 1), ("DC1", 2), ("DC1", 2), ("DC1", 0), (None, 4), ("DC1", None)], "projectcd string, putnr long")
    have = spark.createDataFrame([("PDC1P1", "Put"), (None, "Put"), ("PDC1P2", "Vlak")], "key string, soort string")
    key = keys.build(*keys.parse("P:projectcd P:putnr"))
    out = merge.generate_missing(seen, have, ["projectcd", "putnr"], key, "Put", "putnr")
    assert rows(out, "key", "soort", "herkomst") == [("PDC1P2", "Put", "Gegenereerd")]
    assert merge.generate_missing(seen, have, ["projectcd", "putnr"], key, "Put", "putnr", strict_reference=True).count() == 0


def test_references(spark):
    parents = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 1), (None, 4, 1)], "key string, ID long, _seq long")
    children = spark.createDataFrame([("x", "a", None), ("y", "b", None), ("z", None, None), ("w", "b", 9)], "n string, k string, t long")
    assert rows(references.set_reference(children, parents, "k", "t"), "n", "t") == [("w", 9), ("x", 2), ("y", 3), ("z", None)]
    assert rows(references.set_reference(children, parents, "k", "t", unique_only=True), "n", "t") == [("w", 9), ("x", None), ("y", 3), ("z", None)]
    assert rows(references.integrity(spark.createDataFrame([(1,), (99,), (None,)], "t long"), parents, "t")) == [(99,)]


def test_updates(spark):
    old = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y"), (None, "3", "z")], "k string, v string, o string")
    new = spark.createDataFrame([("a", None, 1), ("b", "7", 1), ("b", "8", 2), ("c", "9", 1), (None, "5", 1)], "k string, v string, _seq long")
    assert rows(references.update_join(old, new, ["k"], ["v"]), "k", "v") == sorted([("a", None), ("b", "8"), (None, "3")], key=str)
    assert rows(writes.upsert(old, new, ["k"], "_seq"), "k", "v", "o") == sorted([("a", "1", "x"), ("b", "8", "y"), ("c", "9", None), (None, "5", "z")], key=str)
    one = new.drop("_seq").where("k = 'c' OR v = '7'")
    assert rows(writes.replace(old, one, ["k"]), "k", "v") == sorted([("a", "1"), ("b", "7"), ("c", "9"), (None, "3")], key=str)
    assert rows(writes.keep_existing(old, one, ["k"]), "k", "v") == sorted([("a", "1"), ("b", "2"), ("c", "9"), (None, "3")], key=str)
    assert writes.fail_existing(old, one.where("k = 'c'"), ["k"]).count() == 4
    with pytest.raises(Exception, match="a row with this key exists"):
        writes.fail_existing(old, one, ["k"]).collect()


def test_several_parents(spark):
    df = spark.createDataFrame([("DC1", 7, 1), ("DC1", 7, 2), ("DC1", 8, 1), ("DC2", None, 1), ("DC2", None, 2)], "p string, v long, put long")
    assert rows(references.several_parents(df, ["p", "v"], "put")) == [("DC1", 7, 2)]
    assert references.several_parents(df, ["p", "v"], "put", strict_reference=True).count() == 2
    assert rows(references.uniqueness(df, ["p"], "v")) == [("DC1", False), ("DC2", True)]


def test_tree_with_a_cycle(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 6), (6, 5), (7, None)], "primary_key long, parentID long")
    assert rows(hierarchy.descendants(tree, F.col("primary_key") == 1), "primary_key", "depth") == [(1, 0), (2, 1), (3, 2), (4, 3)]
    assert rows(hierarchy.descendants(tree, F.col("primary_key") == 5), "primary_key") == [(5,), (6,)]
    assert rows(hierarchy.children(tree, 1), "primary_key") == [(2,)]


def test_deep_tree(spark):
    tree = spark.createDataFrame([(k, k - 1) for k in range(18)], "primary_key long, parentID long").coalesce(1)
    assert rows(hierarchy.descendants(tree, F.col("primary_key") == 0), "primary_key", "depth") == sorted([(k, k) for k in range(18)], key=str)


def test_outline(spark):
    df = spark.createDataFrame([(1, "S", None, None), (2, None, "a", None), (3, None, None, "x"), (4, None, "b", None), (5, None, None, "y"), (6, "T", None, None), (7, None, None, "z")], "o long, l0 string, l1 string, l2 string")
    got = {r.o: (r.uris, r.parent_uri) for r in outline.outline_paths(df, ["l0", "l1", "l2"], "o").collect()}
    assert got == {1: (["S"], None), 2: (["S", "a"], "S"), 3: (["S", "a", "x"], "a"), 4: (["S", "b"], "S"), 5: (["S", "b", "y"], "b"), 6: (["T"], None), 7: (["T", "z"], "T")}


def test_search(spark):
    df = spark.createDataFrame([(1, "rode kan van glas", "kan"), (2, "blauwe kan", "glas"), (3, "Rode RODE pot", None), (4, None, None)], "pk long, beschrijving string, soortnaam string")
    find = lambda q, **k: [r.pk for r in search.search(df, "pk", q, **k).collect()]
    assert find("rode") == [3, 1]
    assert sorted(find("rode kan")) == [1, 2, 3]
    assert find("rode AND kan") == [1]
    assert find("kan NOT glas") == []
    assert find("+kan -rode") == [2]
    assert sorted(find("ro*")) == [1, 3]
    assert sorted(find("ka?")) == [1, 2]
    assert find("soortnaam:glas") == [2]
    assert find('"rode kan"') == [1]
    assert find('"kan rode"') == []
    assert find("") == []
    assert find("glas", fields=["beschrijving"]) == [1]
    assert find("kan", kind=F.col("soortnaam") == "kan") == [1]
    shown = search.search(df, "pk", "rode", ["beschrijving"]).first()
    assert shown.highlight == "<mark>Rode</mark> <mark>RODE</mark> pot"
    index = search.postings(df, "pk", ["beschrijving"])
    changed = search.reindexed(index, spark.createDataFrame([(1, "nieuw")], "pk long, beschrijving string"), "pk", ["beschrijving"])
    assert rows(changed.where("pk = 1"), "term") == [("nieuw",)]


def test_views(spark):
    df = spark.createDataFrame([(1, "Abc", 5), (2, "abd", None), (3, "x", 7)], "pk long, t string, n long")
    pick = lambda *f: [r.pk for r in views.filtered(df, *f).orderBy("pk").collect()]
    assert pick(("t", "starts_with", "AB")) == [1, 2]
    assert pick(("t", "not_ends_with", "d")) == [1, 3]
    assert pick(("n", "greater", 5)) == [3]
    assert pick(("n", "not_in_or_missing", [5])) == [2, 3]
    assert pick(("n", "exists", False)) == [2]
    assert pick(("t", "function", lambda: "x")) == [3]
    assert [r.pk for r in views.page(df, 0, 2, ("n", True), tie="pk").collect()] == [1, 3]
    assert [r.pk for r in views.page(df, 1, 2, ("n", False), tie="pk").collect()] == [1]
    assert rows(views.next_number(df.where("pk > 9"), "pk")) == [(1,)]
    assert views.page_with_total(df, 0, 1, tie="pk")[0] == 3


def test_near_names_equals_all_pairs(spark):
    import random

    rng = random.Random(3)
    names = {"".join(rng.choice("abc") for _ in range(rng.randrange(0, 9))) for _ in range(120)}
    known = {"".join(rng.choice("abc") for _ in range(rng.randrange(0, 9))) for _ in range(120)}
    a, b = spark.createDataFrame([(n,) for n in names], "a string"), spark.createDataFrame([(n,) for n in known], "b string")
    got = {tuple(r) for r in reports.near_names(a, "a", b, "b", 3).collect()}
    every = a.crossJoin(b).withColumn("d", F.levenshtein("a", "b")).where("d < 3")
    assert got == {tuple(r) for r in every.collect()}


def test_phrases_beside_other_words(spark):
    df = spark.createDataFrame([(1, "red apple"), (2, "apple red"), (3, "apple red pear"), (4, "red apple pear"), (5, "plum")], "pk long, t string")
    find = lambda q: sorted(r.pk for r in search.search(df, "pk", q, ["t"]).collect())
    assert find('"red apple" pear') == [1, 3, 4] and find('"red apple" AND pear') == [4] and find('"red apple" OR plum') == [1, 4, 5]
    assert find('apple -"red apple"') == [2, 3] and find('+"apple red" pear') == [2, 3] and find('"re* apple"') == [1, 4]
    index = search.postings(df, "pk", ["t"])
    for query in ("apple pear", "red NOT plum", "app*"):
        with_index, without = ({r.pk: round(r.score, 9) for r in f.collect()} for f in (search.ranked(index, query), search.ranked_rows(df, "pk", ["t"], query)))
        assert with_index == without != {}


def test_lists(spark):
    df = spark.createDataFrame([("g", ["b", "a"], "x"), ("g", ["b"], "y"), ("h", None, None)], "g string, l array<string>, r string")
    assert rows(reports.remarked(df, "g", "l", "r")) == [("g", ["a", "b"], "x,y"), ("h", [], "")]
    assert rows(reports.pushed(spark.createDataFrame([("g", 1), ("g", 1)], "g string, v int"), "g", "v")) == [("g", [1, 1], 2, 2)]
    assert rows(df.limit(1).select(staging.list_items(F.lit("['a', \"b\", 3]")).alias("x"))) == [(["a", "b", "3"],)]
    found = references.lookup(df.select("g").distinct(), "g", spark.createDataFrame([("g", 2), ("g", 1)], "g string, v int"), "g", "rows")
    assert {r.g: [x.v for x in r["rows"]] for r in found.collect()} == {"g": [1, 2], "h": []}


def test_load(spark, tmp_path):
    df = spark.createDataFrame([("12x", "3.7", "Ja", "abcdef", "1-2-2003", {"a": "b"}, "extra")], "i string, d string, f string, s string, t string, m map<string,string>, more string")
    ddl = "i int, d double, f boolean, s varchar(3), t date, m string, absent int"
    assert rows(tables.conformed(df, ddl, keep_nested=False).withColumn("t", F.col("t").cast("string"))) == [(None, 3.7, True, "abc", "2003-02-01", '{"a":"b"}')]
    assert tables.column_report(df, ddl) == {"loaded": ["d", "f", "i", "m", "s", "t"], "undeclared": ["more"], "absent": ["absent"]}
    tables.publish(df, f"{tmp_path}/out", ddl)
    tables.export_csv(spark.createDataFrame([('a;"b"', 1)], "x string, y int").coalesce(1), f"{tmp_path}/csv")
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    assert text == 'x;y\n"a;""b""";1\n'


def test_exports(spark, tmp_path):
    folder = tmp_path / "DC14_Markt" / "db1"
    folder.mkdir(parents=True)
    (folder / "PUT.csv").write_text('PUT,OMSCHR\n1,"a, ""b""\nc"\n2,\n')
    (folder / "ONE.csv").write_text("X\n1\n")
    out = staging.read_exports(spark, f"{tmp_path}/*/*/*.csv", "Oud", "2024-01-01 00:00:00")
    assert rows(out, "table", "projectcd", "mdbfile", "bron", "data") == sorted([("PUT", "DC14", "db1", "Oud", {"PUT": "1", "OMSCHR": 'a, "b"\nc'}), ("PUT", "DC14", "db1", "Oud", {"PUT": "2"})], key=str)


def test_exports_of_many_quoted_rows(spark, tmp_path):
    folder = tmp_path / "DC14_Markt" / "db1"
    folder.mkdir(parents=True)
    (folder / "PUT.csv").write_text("PUT,OMSCHR\r\n" + "".join(f'{k},"rij ""{k}"", met\r\nvervolg"\r\n' for k in range(100_000)))
    (folder / "VONDST.csv").write_text("NR\n1\n2\n")
    out = staging.read_exports(spark, f"{tmp_path}/*/*/*.csv", "Oud", "2024-01-01 00:00:00")
    told = out.where("table = 'PUT'").select(F.count("*"), F.countDistinct("_seq"), F.count_if(F.col("data")["OMSCHR"] == F.concat(F.lit('rij "'), F.col("data")["PUT"], F.lit('", met\nvervolg')))).first()
    assert tuple(told) == (100_000, 100_000, 100_000)
    assert out.select("_seq").distinct().count() == out.count() == 100_002


@pytest.mark.parametrize("size", [37, 1000, 10**8])
def test_exports_in_ranges_equal_a_plain_reader(spark, tmp_path, size):
    rng = random.Random(size)
    pieces = ['a', 'é,', '"', "\n", "\r\n", "x y", "", ", ", "😀", "''", "\n\n"]
    told = {}
    for name in ("A", "B", "C", "D"):
        (tmp_path / f"DC1_x/{name}").mkdir(parents=True)
        lines = [["n", "n", "tekst", "n_2", "n"]] + [[str(k), rng.choice(["", "p"]), "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))), "q", "r"] for k in range(150 if name != "D" else 2)]
        with (tmp_path / f"DC1_x/{name}/T.csv").open("w", newline="", encoding="utf-8-sig" if name == "B" else "utf-8") as f:
            csv.writer(f, lineterminator="\r\n" if name == "C" else "\n\n" if name == "A" else "\n").writerows(lines)
        names = ["n", "n_2", "tekst", "n_2_2", "n_3"]
        told[name] = [{k: v.replace("\r\n", "\n") for k, v in zip(names, line, strict=True) if v.strip(" ")} for line in lines[1:]]
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        out = staging.read_exports(spark, f"{tmp_path}/*/*/*.csv", "Oud", "2024-01-01 00:00:00")
        got = {name: [r.data for r in out.where(F.col("mdbfile") == name).orderBy("_seq").collect()] for name in told}
        ids = out.agg(F.countDistinct("_id"), F.countDistinct("_seq"), F.count("*")).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == told
    assert set(ids) == {452}


def test_exports_with_open_quotes_bytes_and_no_rows(spark, tmp_path):
    (tmp_path / "DC1_x/d").mkdir(parents=True)
    (tmp_path / "DC1_x/d/A.csv").write_bytes(b'a,b\n1,"open\n2,x\n')
    (tmp_path / "DC1_x/d/B.csv").write_bytes(b"a,b\n1,caf\xe9\n2,x,y\n\n3\n")
    (tmp_path / "DC1_x/d/C.csv").write_bytes(b"\n\n")
    (tmp_path / "DC1_x/d/D.csv").write_bytes(b"")
    out = staging.read_exports(spark, f"{tmp_path}/*/*/*.csv", "Oud", "2024-01-01 00:00:00", least_rows=1)
    assert rows(out, "table", "data") == sorted([("A", {"a": "1", "b": '"open\n2,x\n'.strip("\n")}), ("B", {"a": "1", "b": "caf\ufffd"}), ("B", {"a": "2", "b": "x"}), ("B", {"a": "3"})], key=str)


def test_files(spark, tmp_path):
    for name in ("a/x.jpg", "a/x.tif", "a/y.tif", "b/z.exe", "b/w.PDF"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"1")
    found = staging.list_files(spark, str(tmp_path))
    assert rows(found, "fullFileName", "fileType") == [("/a/x.jpg", ".jpg"), ("/a/x.tif", ".tif"), ("/a/y.tif", ".tif"), ("/b/w.PDF", ".pdf")]
    assert rows(staging.to_process(found, done=found.where("fileType = '.pdf'")), "fullFileName") == [("/a/x.jpg",), ("/a/y.tif",)]


def test_metadata_and_thesaurus(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"name":"PUT","table":"PUTTEN","projectcd":"DC1","teller":3,"Description":"d"}\n')
    assert rows(staging.read_metadata(spark, str(tmp_path / "m.json"))) == [("PUT", "PUTTEN", "DC1", 3, {"Description": "d"})]
    assert staging.metadata_of(spark.createDataFrame([], "a int, b string"), "T", "DC1").count() == 2
    abr = spark.createDataFrame([("https://x", "glas, bont"), (None, "y"), ("z", "z")], "uri string, concept string")
    assert rows(staging.read_thesaurus(abr)) == [("https://x", "Glas, Bont")]


def test_reports(spark):
    a = spark.createDataFrame([("t", 1), ("u", 2), (None, 3)], "t string, n long")
    b = spark.createDataFrame([("t", 1), ("v", 2), (None, 3)], "t string, n long")
    assert rows(reports.mismatched(a, b, ["t", "n"])) == [("u", 2, "left"), ("v", 2, "right")]
    assert rows(reports.status(a.na.drop(), b.na.drop(), ["t"])) == [("t", "both"), ("u", "data"), ("v", "meta")]
    assert [tuple(r) for r in reports.fill_rates(a, ["t", "n"]).collect()] == [("t", 2, 3, 67.0), ("n", 3, 3, 100.0)]
    assert rows(reports.longest(spark.createDataFrame([("g", "aa"), ("g", "ab"), ("g", None)], "g string, t string"), "g", "t")) == [("g", "aa")]
