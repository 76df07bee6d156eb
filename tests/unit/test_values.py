"""Codes, labels, numbers, dates, coordinates, file names and datings, against values worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from potsherd.functions import dating, files, geo, values
from potsherd.plans import catalogue


def one(spark, make, *texts, kinds=None):
    names = [f"c{k}" for k in range(len(texts))]
    schema = ", ".join(f"{n} {(kinds or ['string'] * len(texts))[k]}" for k, n in enumerate(names))
    return spark.createDataFrame([tuple(texts)], schema).select(make(*[F.col(n) for n in names]).alias("out")).first().out


@pytest.mark.parametrize("text,code", [("dc-27", "DC027"), ("DB34", "DB034"), ("DC1234", "DC1234"), ("12", "12"), ("DC0027", "DC027"), ("DC", "DC"), ("dc7 oud", "DC007"), (None, None), ("", "")])
def test_project_code(spark, text, code):
    assert one(spark, values.project_code, text) == code


@pytest.mark.parametrize("text,flag", [("Ja", 1), ("1.0", 0), ("n", 0), (None, None), ("TRUE", 1), ("", 0)])
def test_flags(spark, text, flag):
    assert one(spark, values.to_flag, text) == flag


@pytest.mark.parametrize("text,number", [("12", 12), ("12.9", 12), ("-3.2", -3), ("x", None), ("", None), (None, None), ("nan", None), ("1e3", 1000)])
def test_ints(spark, text, number):
    assert one(spark, values.to_int, text) == number
    kept = one(spark, lambda c: values.to_int(c, keep=True), text)
    assert kept == (str(number) if number is not None else text)


@pytest.mark.parametrize("text,day", [("3-4-1999", "1999-04-03"), ("31/12/2001", "2001-12-31"), ("2001-2-3", "2001-02-03"), ("32-1-2000", None), ("geen", None), (None, None)])
def test_dates(spark, text, day):
    assert one(spark, lambda c: values.to_date(c).cast("string"), text) == day


@pytest.mark.parametrize("text,label", [(" bar-baz? ", "Bar-Baz"), ("été d'or", "Été D'Or"), ("", ""), (None, None), ("ROOD 2x", "Rood 2X")])
def test_labels(spark, text, label):
    assert one(spark, values.clean_label, text) == label


def test_small_codes(spark):
    assert one(spark, lambda c: values.report_number(c, F.lit("DAR")), "dar 7") == "dar007"
    assert one(spark, lambda c: values.report_number(c, F.lit("DAN")), "12") == "DAN012"
    assert one(spark, lambda c: values.report_number(c), "12") == "012"
    assert one(spark, values.drawing_code, "C!12") == "C012"
    assert one(spark, values.drawing_code, "C1234") == "C1234"
    assert [one(spark, values.artefact_kind, t) for t in ("gl-bek-1", "wi_kan", "Kleipijp", "x", None)] == ["Glas", "Aardewerk", "Kleipijp", None, None]
    assert one(spark, values.short_name, "Vondst Nummer") == "vondst_nr"
    assert one(spark, values.text_of, 12.0, kinds=["double"]) == "12"
    assert one(spark, values.first_known, "", "0", "a", "b", kinds=["string"] * 4) == "a"
    assert one(spark, values.percent, 1, 8, kinds=["int", "int"]) == 12.0
    assert one(spark, lambda c: values.by_first_match(c, [("PUT", "Put"), ("P", "P")], "Geen"), "PUTTEN") == "Put"
    labels = [one(spark, values.range_label, a, b, kinds=["int", "int"]) for a, b in ((1, 2), (1, None), (0, 2), (None, 0))]
    assert labels == ["1 - 2", "1 -", "- 2", ""]
    assert one(spark, lambda a, b: values.described("spoor", **{"": a, "vlak": b}), "5", "2") == "Spoor 5, vlak 2"


@pytest.mark.parametrize("x,y,lat,lon", [(121687, 487484, 52.37422, 4.89801), (92565, 437428, 51.92183, 4.47959), (176331, 317462, 50.84660, 5.69006)])
def test_grid(spark, x, y, lat, lon):
    found = one(spark, geo.location, float(x), float(y), kinds=["double", "double"])
    assert (found.lat, found.lon) == (pytest.approx(lat, abs=1e-4), pytest.approx(lon, abs=1e-4))
    back = one(spark, lambda a, b: F.array(*geo.wgs_to_rd(a, b)), found.lat, found.lon, kinds=["double", "double"])
    assert back == [pytest.approx(x, abs=1), pytest.approx(y, abs=1)]


def test_no_place(spark):
    for x, y in ((None, 1.0), (1.0, 5.0), (float("nan"), 2.0), (0.0, 0.0)):
        assert one(spark, geo.location, x, y, kinds=["double", "double"]) is None


@pytest.mark.parametrize(
    "name,directory,expected",
    [
        ("DC14_P00_H0000_701_2.JPG", "/DC014/L Fotos/Hout", {"soort": "Foto", "fototype": "H", "putnr": "", "vondstnr": "", "subnr": "701", "fotonr": "2", "projectcd": "DC14"}),
        ("DB10_C12.jpg", "/x", {"soort": "Tekening", "fototype": "C", "tekeningcd": "C012", "bestandsoort": "Overzichtstekeningen"}),
        ("DB10_G007.jpg", "/x", {"soort": "Foto", "fototype": "G", "fotonr": "7", "bestandsoort": "Opgravingsfoto"}),
        ("DAR096 kaart.pdf", "/x", {"soort": "Rapport", "rapportnr": "DAR096", "bestandsoort": "Archeologische_Rapportage"}),
        ("DAN12.pdf", "/x", {"soort": "Rapport", "rapportnr": "DAN012", "bestandsoort": "Archeologische_Notitie"}),
        ("brief.docx", "/x", {"soort": "Rapport", "bestandsoort": "Overige_Rapportage", "rapportnr": "/x/brief.docx"}),
        ("grote tekening.tif", "/DB33/y", {"soort": "Tekening", "fototype": "T", "projectcd": "DB33"}),
        ("aantekening.tif", "/z", {"soort": "Bestand", "fototype": "N", "projectcd": "aantekening"}),
        ("DB10_G007.jpg.jpg", "/x", {"soort": "Foto", "fotonr": "7"}),
    ],
)
def test_file_names(spark, name, directory, expected):
    found = one(spark, lambda n, d: files.classify(n, F.concat(d, F.lit("/"), n), d, files.extension(n)), name, directory)
    assert {k: found[k] for k in expected} == expected


def test_long_numbers_in_file_names_stay_whole(spark, tmp_path):
    rows = [(7, 42), (7, 99999), (7, 100000), (7, 1234567), (9, 42), (9, 1234567)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    out = catalogue.filename_classifier(spark, str(tmp_path)).collect()
    assert sorted((r.o_orderkey, r.vondstnr or r.fotonr) for r in out) == [(7, "100000"), (7, "1234567"), (7, "42"), (7, "99999"), (9, "1234567b"), (9, "42b")]


def test_materials(spark):
    paths = {"/a/Bouwaardewerk/x": "Bouwaardewerk", "/a/Aardewerk/x": "Aardewerk", "/bot menselijk/x": "Menselijk_Bot", "/hout/x": "Hout", "/munt/x": "Munt", "/x": None}
    assert {p: one(spark, files.material, p) for p in paths} == paths
    strict = {p: one(spark, lambda c: files.material(c, True), p) for p in paths}
    assert strict == {"/a/Bouwaardewerk/x": "Aardewerk", "/a/Aardewerk/x": "Aardewerk", "/bot menselijk/x": "Menselijk_Bot", "/hout/x": "Hout", "/munt/x": "Hout", "/x": "Hout"}
    kind = one(spark, files.photo_kind, "/DC1/H Objectfotos/Glas")
    assert (kind.fotosoort, kind.materiaal) == ("Objectfoto", "Glas")


DATINGS = [
    ("1650-1700", 1650, 1700), ("17A", 1700, 1725), ("17a-d", 1700, 1800), ("17A-D", 1700, 1800), ("XVIIb", 1725, 1750), ("LMEb", 1200, 1500), ("romeins", -1200, 450), ("XIV C", 1450, 1475),
    ("16e eeuw", 1500, 1599), ("2e helft 17e eeuw", 1650, 1699), ("1200 n. Chr", 1200, 1200), ("Middeleeuwen tot Moderne Tijd", 450, 1945), ("eerste helft van de 2e eeuw", 100, 149),
    ("2e eeuw v. Chr.", -199, -100), ("300 v. chr.", -300, -300), ("1300 +/- 30 BP", 620, 680), ("jaren '70", 1970, 1979), ("ijzertijd", -800, -13), ("laat-romeinse tijd", -1200, 450), ("middeleewen", 450, 1500),
    ("2 miljoen jaar geleden", -1998000, -1998000), ("?", None, None), ("", None, None), (None, None, None), ("zomaar iets", None, None), ("XVII", 1700, 1700), ("1700,b", 1700, 1750), ("MCMXC", 199000, 199000),
]


def test_datings(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in DATINGS], "t string")
    got = {r.t: (r.d_vanaf, r.d_tot) for r in dating.dated(df, "t", "d").collect()}
    assert got == {t: (a, b) for t, a, b in DATINGS}


def test_literal_datings(spark):
    df = spark.createDataFrame([("17A-D",), ("2e helft 17e eeuw",), ("kwart",)], "t string")
    got = {r.t: (r.d_vanaf, r.d_tot) for r in dating.dated(df, "t", "d", strict_reference=True).collect()}
    assert got == {"17A-D": (1700, 50000), "2e helft 17e eeuw": (150, 199), "kwart": (-1200, 450)}


def test_ontology(spark):
    rows = spark.createDataFrame([("Krijt", -145000000, -66000000, "KR", None)], "label string, start_year int, end_year int, alias1 string, alias2 string")
    table = dating.period_table(rows)
    assert table == {"krijt": (-145000000, -66000000), "kr": (-145000000, -66000000)}
    assert dating.Phrases(table).read("het krijt") == (-145000000, -66000000)


def test_edit_distance():
    assert [dating.distance(a, b, 9) for a, b in (("abc", "abc"), ("abc", "abd"), ("abc", "a"), ("kitten", "sitting"))] == [0, 1, 2, 3]
    assert dating.distance("abc", "abcdefg", 3) == 3
