"""The whole cycle on a small excavation."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from potsherd.operators import references, segments
from potsherd.operators.harmonise import Entity
from potsherd.plans import full_cycle, model
from potsherd.sources import buckets, versions
from potsherd.streaming import changes

ENTITIES = [
    Entity("Project", ("opgravingen",), attributes={"projectcd": ("CODE",), "projectnaam": ("OPGRAVING",), "toponiem": ("TOPONIEM",), "xcoor_rd": ("XCOORD",), "ycoor_rd": ("YCOORD",), "jaar": ("JAAR",)}),
    Entity("Put", ("^put",), attributes={"putnr": ("PUT", "PUTNR")}),
    Entity("Vondst", ("vondst",), attributes={"putnr": ("PUT",), "vondstnr": ("VONDST",), "vondstdatering": ("DAT",)}),
    Entity("Aardewerk", ("aardewerk",), attributes={"putnr": ("PUT",), "vondstnr": ("VONDST",), "artefactnr": ("NR",), "subnr": ("SUB",), "typecd": ("TYPE",), "artefactdatering": ("DAT",), "aantal": ("AANTAL",)}, artefact=True),
    Entity("Foto", ("foto",), attributes={"vondstnr": ("VONDST",), "subnr": ("SUB",), "putnr": ("PUT",), "fotonr": ("NR",), "imageID": ("IMG",)}),
]


def staging(spark):
    def row(n, table, project, **data):
        return (f"i{n}", n, table, project, "Oud", data)

    rows = [
        row(1, "OPGRAVINGEN", "dc-27", CODE="dc-27", OPGRAVING="", TOPONIEM="oude markt", XCOORD="121687", YCOORD="487484", JAAR="1999"),
        row(2, "PUTTEN", "DC27", PUT="1"),
        row(3, "VONDSTEN", "DC27", PUT="1", VONDST="7", DAT="17A"),
        row(4, "VONDSTEN", "DC27", PUT="1", VONDST="7", DAT="-"),
        row(5, "AARDEWERK", "DC27", PUT="1", VONDST="7", NR="1", SUB="5", TYPE="gl-1", DAT="1650-1700", AANTAL="2.9"),
        row(6, "AARDEWERK", "DC27", PUT="1", VONDST="7", NR="1", SUB="5", TYPE="gl-1", AANTAL="4"),
        row(7, "AARDEWERK", "DC27", PUT="3", VONDST="9", NR="2", AANTAL="x"),
        row(8, "FOTOS", "DC27", VONDST="7", SUB="5", PUT="1", NR="1", IMG="abc"),
        row(9, "FOTOS", "DC27", SUB="5", NR="2", IMG="abd"),
    ]
    return spark.createDataFrame(rows, "_id string, _seq long, table string, projectcd string, bron string, data map<string,string>")


def test_cycle(spark, tmp_path):
    out = full_cycle.run(spark, staging(spark), ENTITIES, str(tmp_path))
    by = lambda soort, *c: sorted((tuple(r) for r in out.where(F.col("soort") == soort).select(*c).collect()), key=str)
    assert by("Project", "projectcd", "projectnaam", "jaar", "key") == [("DC027", "Oude Markt", 1999, "PDC027")]
    # put 3 and find 9 are referred to only
    assert by("Put", "key", "herkomst") == [("PDC027P1", None), ("PDC027P3", "Gegenereerd")]
    assert by("Vondst", "key", "vondstdatering_vanaf", "brondata_count") == [("PDC027V7", 1700, 2), ("PDC027V9", None, None)]
    found = by("Artefact", "key", "artefactsoort", "aantal", "artefactdatering_vanaf", "brondata_count")
    assert found == [("PDC027P1V7A1", "Glas", 4, 1650, 2), ("PDC027P3V9A2", "Aardewerk", None, None, 1)]
    ids = {r.key: r.ID for r in out.where("soort = 'Artefact'").collect()}
    photos = by("Bestand", "fotonr", "artefactID", "projectID")
    assert photos == [("1", ids["PDC027P1V7A1"], 0), ("2", ids["PDC027P1V7A1"], 0)]
    for target, soort in (("projectID", "Project"), ("putID", "Put"), ("vondstID", "Vondst")):
        have = {r.ID for r in out.where(F.col("soort") == soort).collect()}
        assert {r[0] for r in out.where(f"{target} IS NOT NULL").select(target).collect()} <= have
    typed = versions.published(spark, f"{tmp_path}/load", "Def_Artefact")
    assert dict(typed.dtypes)["aantal"] == "int" and typed.count() == 2
    n = out.count()
    assert full_cycle.run(spark, staging(spark), ENTITIES, str(tmp_path), start="references").count() == n


def test_numbers_last_from_load_to_load(spark, tmp_path):
    more = spark.createDataFrame([("i0", 0, "PUTTEN", "DC27", "Oud", {"PUT": "0"}), ("i01", 1, "VONDSTEN", "DC27", "Oud", {"PUT": "0", "VONDST": "1"})], staging(spark).schema)
    numbers = []
    for load, rows in enumerate((staging(spark), more.unionByName(staging(spark)))):
        out = full_cycle.run(spark, rows, ENTITIES, f"{tmp_path}/{load}", registry=f"{tmp_path}/registry", load=load)
        numbers.append({(r.soort, r.key): r.ID for r in out.where("key IS NOT NULL").collect()})
        finds = {r.key: r.putID for r in out.where("soort = 'Vondst'").collect()}
        assert finds["PDC027V7"] == numbers[-1]["Put", "PDC027P1"]
    assert numbers[0].items() <= numbers[1].items() and len(numbers[1]) == len(numbers[0]) + 2
    assert finds["PDC027V1"] == numbers[1]["Put", "PDC027P0"]


def test_one_pass_equals_one_rule_after_the_other(spark):
    rng = random.Random(4)
    data = [(rng.choice("ABC"), rng.choice([None, *"klmnop"]), rng.choice([None, *"klmnop"]), rng.choice([None, *"klmnopq"]), rng.choice([None, *"klmnopq"]), rng.choice([None, 99]), n, n) for n in range(300)]
    df = spark.createDataFrame(data, "soort string, key string, other string, to_a string, to_b string, aID long, ID long, _seq long")
    rules = [references.Rule("to_a", "A", "key", "aID"), references.Rule("to_b", "B", "other", "bID", True), references.Rule("to_a", "B", "key", "bID"), references.Rule("to_b", "C", "key", "cID"), references.Rule("none", "C", "key", "dID")]
    want = df
    for r in rules[:-1]:
        parents = df.where((F.col("soort") == r.kind) & F.col(r.parent_key).isNotNull()).select(r.parent_key, "ID", "_seq")
        want = references.set_reference(want, parents, r.child_key, r.target, r.unique_only, r.parent_key, candidates=F.col("soort") != r.kind)
    got = references.set_all(df, rules)
    assert {*got.columns} == {*want.columns} and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(*got.columns).collect()), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = references.set_all(df, rules)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 4  # keys, parents, what they give by row, and the store by row
    assert references.set_all(df, rules[-1:]) is df


def test_folders_tell_projects(spark):
    rows = [("Project", "DC001", None, "p"), ("Project", "DC002", None, "p"), ("Foto", None, "/x/DC001/DC002 put/H Objectfotos/Glas", "a"), ("Foto", "", "/DC002/DC001/Opgravingsfoto", "b"), ("Foto", "Q1", "/DC001", "c"), ("Foto", None, "/DC0011", "d"), ("Foto", None, None, "e"), ("Put", None, "/DC001", "f")]
    out = full_cycle.with_folders(spark.createDataFrame(rows, "soort string, projectcd string, directory string, _id string"))
    got = {r._id: (r.projectcd, r.fotosoort, r.materiaal) for r in out.where("_id <> 'p'").collect()}
    assert got == {"a": ("DC002", "Objectfoto", "Glas"), "b": ("DC001", "Opgravingsfoto", None), "c": ("Q1", "Overige_afbeelding", None), "d": (None, "Overige_afbeelding", None), "e": (None, None, None), "f": (None, None, None)}
    assert out.count() == len(rows)


def test_specs_are_whole():
    assert len(model.SPECS) == len(model.BY_SOORT)
    for child_key, soort, parent_key, _, _ in model.REFERENCES:
        assert soort in model.BY_SOORT
        assert any(child_key in s.patterns() for s in model.SPECS)
        assert parent_key in model.BY_SOORT[soort].patterns()


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jpg").write_bytes(b"1")
    queue = lambda: changes.append_new(changes.file_queue(spark, str(source)), f"{tmp_path}/out", f"{tmp_path}/c1").awaitTermination()
    queue()
    (source / "b.jpg").write_bytes(b"22")
    queue()
    queue()
    assert sorted(r.fileSize for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]

    new = tmp_path / "changes"
    schema = "k string, text string, at long"
    follow = lambda: changes.follow_changes(spark.readStream.schema(schema).json(str(new)), f"{tmp_path}/t", ["k"], f"{tmp_path}/c2", "at").awaitTermination()
    index = lambda: changes.follow_index(spark.readStream.schema(schema).json(str(new)), f"{tmp_path}/x", "k", ["text"], f"{tmp_path}/c3").awaitTermination()
    new.mkdir()
    (new / "1.json").write_text('{"k":"a","text":"rode kan","at":1}\n{"k":"b","text":"pot","at":2}\n')
    follow(), index()
    (new / "2.json").write_text('{"k":"a","text":"kom","at":3}\n')
    follow(), index()
    assert sorted((r.k, r.text) for r in buckets.read(spark, f"{tmp_path}/t").collect()) == [("a", "kom"), ("b", "pot")]
    assert sorted((r.pk, r.term) for r in segments.postings(spark, f"{tmp_path}/x").collect()) == [("a", "kom"), ("b", "pot")]
    counted = changes.counts(spark.readStream.schema(schema).json(str(new)), ["k"])
    counted.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.k, r.n) for r in spark.table("counted").collect()) == [("a", 2), ("b", 1)]
