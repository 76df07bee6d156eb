"""The registered queries of the library, each through the operator that the cycle itself uses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from potsherd.functions import dating, files, geo, values
from potsherd.operators import harmonise, hierarchy, intervals, keys, merge, outline, photos, profiles, references, reports, search, segments, views, writes
from potsherd.plans.oracles import ORACLES as ORACLES
from potsherd.sources import buckets, paged, staging, tables, versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(items: Column) -> Column:
    return F.array_join(items, ",")


def line_order() -> Column:
    """A number for each line of an order; line numbers alone may repeat."""
    return F.col("l_linenumber").cast("bigint") * 10**15 + F.col("l_partkey") * 10**8 + F.col("l_suppkey")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of each located nation, as the map shows finds of each located project."""
    return outer_join_counts(spark, sf_dir)


# projections and filters


@query
def coalesce_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderpriority").alias("priority"))
    both = read(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    rows = both.select("c_custkey", F.map_from_arrays(F.array(F.lit("a"), F.lit("b")), F.array(F.col("priority"), F.col("c_mktsegment"))).alias("data"))
    return rows.select("c_custkey", harmonise.first_of(F.col("data"), ("a", "b")).alias("label"), harmonise.first_of(F.col("data"), "constant").alias("fixed"))


@query
def harmonised_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and customers as two entities of one store, from staging rows of different shape."""
    rows = staging.from_table(read(spark, sf_dir, "supplier"), "supplier", "s_suppkey").unionByName(staging.from_table(read(spark, sf_dir, "customer"), "customer", "c_custkey"))
    party = harmonise.Entity("Partij", ("nothing",), attributes={"name": ("c_name", "s_name"), "nation": ("c_nationkey", "s_nationkey")})
    sell = harmonise.Entity("Verkoper", ("SUPP",), attributes={"number": ("s_suppkey",)}, inherits=party)
    buy = harmonise.Entity("Koper", ("cust",), ("supp",), {"number": ("c_custkey",), "name": ("c_name",)}, party, {"segment": "known"})
    return harmonise.store(rows, [sell, buy]).select("soort", values.to_int(F.col("number")).alias("number"), "name", values.to_int(F.col("nation")).alias("nation"), "segment")


@query
def table_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.where(harmonise.routed(F.col("p_type"), ("econ", "^s"), ("standard",))).select("p_partkey", "p_type")


@query
def drop_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    out = harmonise.without_sentinels(orders, ["o_orderpriority", "o_orderstatus"], ("F", "5-LOW", "Unknown", "-"))
    return out.groupBy("o_orderstatus").agg(F.count("o_orderpriority").alias("priorities"), F.count(F.lit(1)).alias("n"))


@query
def code_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [("^[12]-", "HIGH"), ("URGENT", "NOW"), ("^[345]-", "LATER"), ("LOW$", "LAST")]
    orders = read(spark, sf_dir, "orders").select("o_orderkey", values.rewritten(F.col("o_orderpriority"), rules).alias("code"))
    return orders.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query
def ui_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    picked = views.filtered(orders, ("o_orderstatus", "in", ["O", "F"]), ("o_orderpriority", "not_starts_with", "1-"), ("o_orderpriority", "contains", "h"), ("o_totalprice", "greater", 1000.0), ("o_custkey", "not_equal", 1))
    return picked.select("o_orderkey", "o_orderstatus", "o_orderpriority")


#: A filter of a search form by each of its kinds: column and value.
ASKED = {
    "equal": ("o_orderstatus", "O"),
    "not_equal": ("known_priority", "1-URGENT"),
    "starts_with": ("known_priority", "2-h"),
    "not_starts_with": ("known_priority", "2-h"),
    "ends_with": ("known_priority", "HIGH"),
    "not_ends_with": ("known_priority", "high"),
    "contains": ("known_priority", "edi"),
    "not_contains": ("known_priority", "EDI"),
    "greater": ("o_totalprice", 200000.0),
    "smaller": ("o_totalprice", 200000.0),
    "in": ("known_priority", ["2-HIGH", "3-MEDIUM"]),
    "not_in": ("known_priority", ["2-HIGH", "3-MEDIUM"]),
    "not_in_or_missing": ("known_priority", ["2-HIGH", "3-MEDIUM"]),
    "exists": ("known_priority", True),
    "relation": ("o_custkey", 7),
    "not_relation": ("o_custkey", 7),
    "function": ("o_orderstatus", lambda: "F"),
    "matches": ("known_priority", "^[23]-.*m$"),
}


@query
def ui_filters_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many orders fit each kind of filter, in one pass; priorities are missing for some orders."""
    orders = read(spark, sf_dir, "orders").withColumn("known_priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    fits = [F.count_if(views.FILTERS[kind](F.col(column), value)).alias(kind) for kind, (column, value) in ASKED.items()]
    return orders.agg(*fits).unpivot([], list(ASKED), "filter", "n")


@query
def relation_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that a given supplier has sold: a relation of many to many."""
    line = read(spark, sf_dir, "lineitem")
    return views.related(read(spark, sf_dir, "part"), "p_partkey", line, "l_partkey", "l_suppkey", 3).select("p_partkey", "p_name")


@query
def discriminator_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.subtype(read(spark, sf_dir, "orders"), "o_orderstatus", "P", ["o_orderkey", "o_custkey"], ["o_totalprice"])


@query
def material_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("kind"), F.col("p_size").alias("uri"))
    allowed = part.where("uri < 20").select("kind", "uri").where("kind < 'Brand#3'").distinct()
    return views.material_faults(part, allowed, "kind", "uri").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


# keys and scalar functions


@query
def key_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") != 2, F.col("l_partkey")).alias("part"),
        F.when(F.col("l_linenumber") != 3, F.col("l_suppkey")).alias("supp"),
        (F.col("l_returnflag") == "R").alias("flag"),
    )
    out = keys.with_keys(line, {"key": "P:l_orderkey [P:part] V:supp", "key_vondst": "P:l_orderkey flag?P:part V:l_linenumber"})
    return out.select("l_orderkey", "l_linenumber", "key", "key_vondst")


@query
def project_code_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lower(F.substring("c_mktsegment", 1, 2)), F.when(F.col("c_custkey") % 2 == 0, "-").otherwise(""), F.col("c_custkey").cast("string"), F.lit(" x"))
    return read(spark, sf_dir, "customer").select("c_custkey", values.project_code(raw).alias("projectcd"))


@query
def label_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select("p_partkey", values.clean_label(F.concat(F.lit(" ?"), F.col("p_type"), F.lit("-"), F.col("p_name"), F.lit("? "))).alias("label"))
    return part


@query
def int_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit("x"))).otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
    return read(spark, sf_dir, "part").select("p_partkey", values.to_int(text).alias("forced"), values.to_int(F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.col("p_size").cast("string")), keep=True).alias("kept"))


@query
def bool_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.element_at(F.array(*map(F.lit, ("Ja", "nee", "1", "TRUE", "y", "0", "N"))), (F.col("o_orderkey") % 7 + 1).cast("int"))
    text = F.when(F.col("o_orderkey") % 11 != 0, word)
    return read(spark, sf_dir, "orders").select(values.to_flag(text).cast("bigint").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


@query
def date_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    text = F.when(F.col("o_orderkey") % 4 == 0, F.date_format(day, "d-M-yyyy")).when(F.col("o_orderkey") % 4 == 1, F.date_format(day, "dd/MM/yyyy")).when(F.col("o_orderkey") % 4 == 2, F.date_format(day, "yyyy-MM-dd")).otherwise("geen")
    return read(spark, sf_dir, "orders").select("o_orderkey", values.to_date(text).cast("string").alias("day"))


@query
def rd_to_wgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = 20000 + F.col("c_custkey") % 250000, 310000 + F.col("c_custkey") * 7 % 300000
    latitude, longitude = geo.rd_to_wgs(x, y)
    return read(spark, sf_dir, "customer").select("c_custkey", F.round(latitude, 6).alias("lat"), F.round(longitude, 6).alias("lon"))


@query
def located_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points of a map: missing coordinates and those that stand for none give no point."""
    k = F.col("c_custkey")
    x = F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, F.lit(1)).otherwise(20000 + k % 250000)
    placed = read(spark, sf_dir, "customer").select("c_custkey", geo.valid(x, 310000 + k * 7 % 300000).alias("valid"), geo.location(x, 310000 + k * 7 % 300000).alias("at"))
    made = placed.withColumn("point", F.when(F.col("at").isNotNull(), geo.point(F.col("at.lon"), F.col("at.lat"))))
    return made.select("c_custkey", "valid", F.col("point.type").alias("type"), *[F.round(F.get("point.coordinates", F.lit(i)), 6).alias(n) for i, n in enumerate(("lon", "lat"))])


@query
def toponym_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by name; a missing or blank one is replaced by the type, in title case."""
    k = F.col("p_partkey")
    name = F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, F.lit("  ")).otherwise(F.col("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", harmonise.toponym_name(name, F.col("p_type")).alias("name"))


@query
def default_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of each priority, where missing and empty ones got a default."""
    k = F.col("o_orderkey")
    orders = read(spark, sf_dir, "orders").select("o_totalprice", F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, F.lit("")).otherwise(F.col("o_orderpriority")).alias("priority"))
    return merge.with_default(orders, "priority", "Onbekend").groupBy("priority").agg(F.count(F.lit(1)).alias("n"))


@query
def wgs_to_rd(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = geo.wgs_to_rd(F.lit(51.0) + F.col("c_custkey") % 1000 / 500, F.lit(4.0) + F.col("c_custkey") % 900 / 400)
    return read(spark, sf_dir, "customer").select("c_custkey", F.round(x, 2).alias("x"), F.round(y, 2).alias("y"))


@query
def year_range_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    century = (F.col("o_orderkey") % 12 + 8).cast("string")
    letter = F.substr(F.lit("abcd"), (F.col("o_orderkey") % 4 + 1).cast("int"), F.lit(1))
    numeral = F.element_at(F.array(*map(F.lit, ("XVII", "XIV", "IX", "XIX", "XVI"))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    code = (
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(century, letter))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), (F.year("o_orderdate") + F.col("o_orderkey") % 9).cast("string")))
        .otherwise(F.concat(numeral, letter))
    )
    found = dating.ranged(read(spark, sf_dir, "orders").select("o_orderkey", code.alias("code")), "code")
    return found.select("o_orderkey", "code", F.col("vanaf").cast("bigint").alias("vanaf"), F.col("tot").cast("bigint").alias("tot"))


@query
def dating_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in words, read by the phrase parser: nations take the place of finds."""
    phrases = ("1200 n. Chr", "Middeleeuwen tot Moderne Tijd", "eerste helft van de 2e eeuw", "2e eeuw v. Chr.", "1300 +/- 30 BP", "jaren 1940", "onbekend woord", "ijzertijd", "16e eeuw", "300 v. chr.")
    text = F.element_at(F.array(*map(F.lit, phrases)), (F.col("n_nationkey") % len(phrases) + 1).cast("int"))
    rows = read(spark, sf_dir, "nation").select("n_nationkey", text.alias("phrase"))
    return dating.dated(rows, "phrase", "d").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "phrase", F.col("d_vanaf").cast("bigint").alias("vanaf"), F.col("d_tot").cast("bigint").alias("tot"))


@query
def filename_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    number = values.padded(F.col("o_custkey").cast("string"), 5)
    name = (
        F.when(k % 7 == 0, F.concat(F.lit("DB10_P02_H"), number, F.lit("_7_"), F.lit("01.JPG")))
        .when(k % 7 == 1, F.concat(F.lit("DC"), (k % 90 + 10).cast("string"), F.lit("_C"), (k % 50).cast("string"), F.lit(".jpg")))
        .when(k % 7 == 2, F.concat(F.lit("DC20_G"), number, F.lit("b.jpg.jpg")))
        .when(k % 7 == 3, F.concat(F.lit("DAR"), (k % 90 + 10).cast("string"), F.lit(" kaart.pdf")))
        .when(k % 7 == 4, F.lit("overzicht tekening.tif"))
        .when(k % 7 == 5, F.lit("brief.docx"))
        .otherwise(F.lit("aantekening x.png"))
    )
    directory = F.lit("/DB33/L Fotos/Glas")
    found = files.classify(name, F.concat(directory, F.lit("/"), name), directory, F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)))
    out = read(spark, sf_dir, "orders").select("o_orderkey", found.alias("f"))
    return out.select("o_orderkey", "f.soort", "f.fototype", "f.bestandsoort", "f.projectcd", "f.vondstnr", "f.fotonr", "f.tekeningcd", "f.rapportnr", "f.artefactsoort")


@query
def photo_sorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    letter = F.substring("c_mktsegment", 1, 1)
    kind = F.when(letter == "B", "H").when(letter == "A", "G").otherwise(letter)
    directory = F.when(F.col("c_custkey") % 5 == 0, "/DC1/H Objectfotos").when(F.col("c_custkey") % 5 == 1, "/Velddocumenten/h object")
    return read(spark, sf_dir, "customer").select("c_custkey", files.photo_sort(kind, directory).alias("fotosoort"))


@query
def first_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first value that is no null, zero or empty text."""
    line = read(spark, sf_dir, "lineitem")
    texts = [(F.col("l_partkey") % 2).cast("string"), F.when(F.col("l_suppkey") % 3 == 0, F.lit("")).when(F.col("l_suppkey") % 3 == 1, "b"), F.col("l_returnflag")]
    return line.select(values.first_known(*texts).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query
def drawing_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat(F.substring("c_mktsegment", 1, 1), F.when(F.col("c_custkey") % 2 == 0, "-").otherwise("?"), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 7 == 0, "x").otherwise("!"))
    return read(spark, sf_dir, "customer").select("c_custkey", values.drawing_code(code).alias("tekeningcd"))


@query
def artefact_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array(*map(F.lit, ("wi_kan-1", "GL-bek", "gl_x", "Kleipijp", "r-pot", "abc_d", "steen")))
    code = F.element_at(codes, (F.col("p_partkey") % 7 + 1).cast("int"))
    return read(spark, sf_dir, "part").select(values.artefact_kind(code).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query
def table_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables sorted under the first pattern that fits their name's beginning."""
    found = values.by_first_match(F.col("p_type"), [("ECON", "A"), ("S(MALL|TAND)", "B"), ("SMALL", "C")], "Geen")
    return read(spark, sf_dir, "part").select(found.alias("object")).groupBy("object").agg(F.count(F.lit(1)).alias("n"))


@query
def report_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("dar "), F.col("c_custkey").cast("string"))).when(F.col("c_custkey") % 3 == 1, F.col("c_custkey").cast("string")).otherwise("zonder nr")
    return read(spark, sf_dir, "customer").select("c_custkey", values.report_number(text, F.lit("DAN")).alias("rapportnr"))


@query
def range_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.select("p_partkey", values.range_label(F.col("p_size") % 4, F.col("p_size") % 3).alias("label"))


# joins


@query
def generate_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that no line belongs to."""
    seen = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("nr"))
    existing = read(spark, sf_dir, "lineitem").select(F.concat(F.lit("C"), F.col("l_orderkey").cast("string")).alias("key"), F.lit("Klant").alias("soort"))
    return merge.generate_missing(seen, existing, ["nr"], keys.build(*keys.parse("C:nr")), "Klant", "nr")


@query
def set_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select(F.col("n_name").alias("key"), F.col("n_nationkey").alias("ID"), F.col("n_nationkey").alias("_seq"))
    names = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("name"))
    customer = read(spark, sf_dir, "customer").join(names, F.col("c_nationkey") == F.col("nk"), "left").withColumn("key_nation", F.when(F.col("c_acctbal") >= 0, F.col("name")))
    return references.set_reference(customer, nation, "key_nation", "nationID").select("c_custkey", "nationID")


@query
def references_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations, customers, suppliers, parts, orders and lines as one store, all their references set at once; parts of a brand and size only where there is one."""
    label = F.concat_ws("|", "p_brand", F.col("p_size").cast("string"))

    def kind(name: str, table: str, number: str, **columns: Column) -> DataFrame:
        return read(spark, sf_dir, table).select(F.lit(name).alias("soort"), F.col(number).cast("bigint").alias("ID"), F.col(number).cast("bigint").alias("_seq"), *[c.cast("string").alias(n) for n, c in columns.items()])

    line = read(spark, sf_dir, "lineitem")
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), label.alias("label"))
    lines = line.join(parts, "l_partkey", "left").select(F.lit("L").alias("soort"), line_order().alias("ID"), line_order().alias("_seq"), F.col("l_orderkey").cast("string").alias("to_order"), F.col("l_suppkey").cast("string").alias("to_supplier"), F.col("label").alias("to_part"))
    rows = [
        kind("N", "nation", "n_nationkey", key=F.col("n_nationkey")),
        kind("C", "customer", "c_custkey", key=F.col("c_custkey"), to_nation=F.col("c_nationkey")),
        kind("S", "supplier", "s_suppkey", key=F.col("s_suppkey"), to_nation=F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey"))),
        kind("P", "part", "p_partkey", label=label),
        kind("O", "orders", "o_orderkey", key=F.col("o_orderkey"), to_customer=F.col("o_custkey")),
        lines,
    ]
    store = rows[0]
    for other in rows[1:]:
        store = store.unionByName(other, allowMissingColumns=True)
    rules = [("to_nation", "N", "key", "nationID"), ("to_customer", "C", "key", "customerID"), ("to_order", "O", "key", "orderID"), ("to_supplier", "S", "key", "supplierID"), ("to_part", "P", "label", "partID", True)]
    out = references.set_all(store, [references.Rule(*r) for r in rules])
    return out.select("soort", F.col("ID").alias("nr"), *[r[3] for r in rules])


@query
def unique_match_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select(F.concat_ws("|", "p_brand", F.col("p_size").cast("string")).alias("key"), F.col("p_partkey").alias("ID"), F.col("p_partkey").alias("_seq"))
    asked = read(spark, sf_dir, "part").select("p_brand", "p_size").distinct().withColumn("want", F.concat_ws("|", "p_brand", F.col("p_size").cast("string")))
    return references.set_reference(asked, part, "want", "partID", unique_only=True).select("want", "partID")


@query
def fallback_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's first line by order and number, or else the only line of the order."""
    line = read(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key_a"),
        F.col("l_orderkey").cast("string").alias("key_b"),
        F.col("l_partkey").alias("ID"),
        F.col("l_linenumber").alias("_seq"),
    )
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.col("o_orderkey").cast("string"), F.lit("-2")).alias("want_a"), F.col("o_orderkey").cast("string").alias("want_b"))
    return references.set_reference_fallback(orders, line, [("want_a", "key_a", False), ("want_b", "key_b", True)], "partID").select("o_orderkey", "partID")


@query
def folder_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as photos in folders that name one or two customers as projects, not all of which are known."""
    customers = read(spark, sf_dir, "customer").select(F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("C"), F.col("c_custkey").cast("string"))).alias("projectcd"))
    below = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("H Objectfotos/"), "o_orderpriority")).when(F.col("o_orderstatus") == "O", "Opgravingsfotos").otherwise("Velddocumenten")
    path = F.concat(F.lit("/f/C"), F.col("o_custkey").cast("string"), F.lit("/jaar "), F.year("o_orderdate").cast("string"), F.lit(" C"), (F.col("o_custkey") % 100).cast("string"), F.lit("/"), below)
    orders = read(spark, sf_dir, "orders").select("o_orderkey", path.alias("directory"), F.when(F.col("o_custkey") % 7 == 0, "eigen").alias("projectcd"))
    return photos.with_folder_facts(orders, customers).select("o_orderkey", "projectcd", "fotosoort", "materiaal")


@query
def update_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    news = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")).alias("o_orderstatus"), line_order().alias("_seq")).where("l_linenumber > 2")
    return references.update_join(rows, news, ["o_orderkey"], ["o_orderstatus"])


@query
def photo_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, file = read(spark, sf_dir, "customer"), F.concat("c_name", F.lit(".jpg"))
    photos = customer.select(F.col("c_custkey").alias("nr"), file.alias("fileName"))
    links = customer.select(F.when(F.col("c_acctbal") >= 0, file).alias("bestandsnaam"), F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("abcd_nr"), F.concat(F.lit("dc"), F.col("c_nationkey").cast("string")).alias("projectcd"))
    told = customer.select(F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("x\\y\\a"), F.col("c_custkey").cast("string"))).alias("pad"), F.concat(F.lit("DC"), F.col("c_nationkey").cast("string")).alias("projectcd"), F.col("c_name").alias("omschrijving"))
    return references.photo_merge(photos, links, told).select("nr", "fileName", "abcd_nr", "omschrijving")


@query
def sample_project_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = read(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("P"), (F.col("s_suppkey") % 40).cast("string")).alias("project"))
    codes = read(spark, sf_dir, "nation").select(F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("project"), F.concat(F.lit("P"), (F.col("n_nationkey") + 10).cast("string")).alias("projectcd"), F.col("n_nationkey").alias("_seq"))
    return harmonise.sample_project_codes(samples, codes)


@query
def outer_join_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read(spark, sf_dir, "supplier")
    return views.map_counts(read(spark, sf_dir, "nation"), "n_nationkey", F.col("n_regionkey") < 4, ["n_name"], supplier, "s_nationkey", "s_suppkey")


@query
def map_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = views.markers(outer_join_counts(spark, sf_dir))
    return out.select("n_name", F.col("radius").cast("bigint").alias("radius"), "color")


@query
def merge_specific(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as specific rows; the first line of each order as the generic one."""
    line = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.when(F.col("l_linestatus") == "O", F.col("l_returnflag")).alias("status"), F.col("l_partkey").alias("part"), line_order().alias("_seq"))
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    return merge.merge_specific(orders, line, "k")


@query
def close_match_levenshtein(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    names = nation.select(F.col("n_name").alias("name")).unionByName(region.select(F.col("r_name").alias("name")))
    return reports.near_names(names, "name", nation, "n_name", 4).withColumn("distance", F.col("distance").cast("bigint"))


@query
def close_match_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = ["AFRIKA", "AMERIKA", "AZIE", "EUROPA", "MIDDEN OOSTEN"]
    return reports.close_matches(read(spark, sf_dir, "region"), "r_name", known).withColumn("ratio", F.round("ratio", 6))


# aggregations


@query
def merge_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select(F.col("user_id").alias("u"), "event_type", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"), F.when(F.col("event_id") % 2 == 0, F.col("ts")).alias("ts"), F.col("event_id").alias("_seq"))
    out = merge.merge_duplicates(events, ["u", "event_type"])
    return out.select("u", "event_type", "value", F.unix_timestamp("ts").alias("ts"), "_seq")


@query
def lineage_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merge.lineage_set(read(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_returnflag", "l_linestatus"])
    shown = F.array_join(F.transform("lineage", lambda s: F.concat_ws(":", s.l_returnflag, s.l_linestatus)), ",")
    return out.select("l_orderkey", shown.alias("lineage"), F.col("brondata_count").cast("bigint").alias("brondata_count"))


@query
def uniqueness_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.uniqueness(read(spark, sf_dir, "lineitem").select("l_suppkey", F.when(F.col("l_quantity") > 5, F.col("l_partkey")).alias("p")), ["l_suppkey"], "p")


@query
def multi_parent_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.several_parents(read(spark, sf_dir, "lineitem"), ["l_partkey"], "l_suppkey")


@query
def denormalised_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.with_counts(read(spark, sf_dir, "customer"), "c_custkey", read(spark, sf_dir, "orders"), "o_custkey", "n_orders").select("c_custkey", "n_orders")


@query
def chart_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.counts_by(read(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority", pk="o_orderkey")


@query
def next_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.next_number(read(spark, sf_dir, "orders"), "o_orderkey")


@query
def two_level_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem").withColumn("supp", (F.col("l_suppkey") % 10).cast("string"))
    out = reports.two_levels(line, "supp", "l_returnflag", "loaded")
    return out.select("l_returnflag", joined(F.col("projects")).alias("projects"), "n_rows", "n_projects", "stage")


@query
def fill_rate_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    wide = customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_mktsegment", "o_orderkey", "o_orderdate", "c_custkey")
    return reports.fill_rates(wide, ["o_orderkey", "o_orderdate", "c_custkey"], "c_mktsegment")


@query
def data_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.profile(read(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query
def profile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different values, quartiles and frequent values of all lines, merged from sketches of each flag's lines."""
    columns = ["l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"]
    parts = profiles.sketches(read(spark, sf_dir, "lineitem"), columns, "l_returnflag")
    return profiles.told(profiles.merged(parts, columns), columns)


@query
def pushed_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.pushed(read(spark, sf_dir, "part"), "p_brand", "p_size")
    return out.select("p_brand", joined(F.col("items").cast("array<string>")).alias("items"), "n", F.col("n_items").cast("bigint").alias("n_items"))


@query
def flattened_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.flattened(read(spark, sf_dir, "part").select("p_brand", F.split("p_type", " ").alias("words")), "p_brand", "words")
    return out.select("p_brand", joined(F.col("items")).alias("items"))


@query
def longest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.longest(read(spark, sf_dir, "part"), "p_brand", "p_name")


@query
def frequency_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.frequencies(read(spark, sf_dir, "events"), "event_type")


@query
def stage_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("source", "lang", "n_chars")
    stages = {"staged": docs, "single": docs.where("lang = 'en'"), "clean": docs.where("n_chars > 1000"), "loaded": docs.where("n_chars > 20000"), "meta": docs.where("lang != 'fr'")}
    return reports.reconciled(stages, "source")


@query
def stage_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    count = lambda df: df.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    return reports.mismatched(count(docs), count(docs.where("n_chars < 8000")), ["source", "lang", "n"])


@query
def data_meta_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("nr")), read(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 40).alias("nr"))
    return reports.status(customer, supplier, ["nr"])


# windows, order, sets


@query
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("soort"), F.col("c_custkey").alias("_seq"))
    return keys.with_surrogates(customer).select("soort", F.col("_seq").alias("c_custkey"), "ID")


@query
def page_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.page(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), 3, 25, ("o_orderpriority", True), ("o_custkey", False), tie="o_orderkey")


@query
def page_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page from far within all orders, from a table that is kept in the view's order."""
    root, by = versions.scratch(spark, "paged"), (("o_orderpriority", True), ("o_custkey", False))
    paged.store(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), root, *by, tie="o_orderkey", rows=10_000)
    middle = paged.total(spark, root) // 2 // 25
    return paged.page(spark, root, middle, 25, *by, tie="o_orderkey").withColumn("page", F.lit(middle).cast("bigint"))


@query
def key_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of parties from a registry: the suppliers' run first, then customers and suppliers together, as they were and new."""
    root = versions.scratch(spark, "registry")
    supplier = read(spark, sf_dir, "supplier").select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("soort"), F.col("s_name").alias("key"), F.col("s_name").alias("_id"))
    customer = read(spark, sf_dir, "customer").select(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("soort"), F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("key"), F.col("c_name").alias("_id"))
    first = keys.with_registered(supplier, root, 0).select("soort", "_id", F.col("ID").alias("first"))
    both = keys.with_registered(supplier.unionByName(customer), root, 1)
    return both.join(first, ["soort", "_id"], "left").select("soort", "_id", F.col("ID").alias("nr"), "first")


@query
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.keep_first(read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query
def union_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.appended(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("nr"), F.col("s_name").alias("name")), read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("nr"), F.col("c_mktsegment").alias("segment")))


@query
def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nr")).intersect(read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nr")))


@query
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("nr")).subtract(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("nr")))


@query
def file_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are wanted and not done, without a tif that has a jpg beside it."""
    pages = read(spark, sf_dir, "pages").select("page_id")
    kind = F.when(F.col("page_id") % 3 == 0, ".tif").when(F.col("page_id") % 3 == 1, ".jpg").otherwise(".exe")
    paths = pages.select(F.concat(F.lit("/root/f/d"), F.floor(F.col("page_id") / 6).cast("string"), F.lit("/n"), F.floor(F.col("page_id") / 3 % 2).cast("string"), kind).alias("path"))
    found = staging.described_files(paths.unionByName(paths.where("path LIKE '%0.tif'").select(F.replace("path", F.lit("n0.tif"), F.lit("n2.tif")).alias("path"))), "f")
    return staging.to_process(found, done=found.where("fullFileName LIKE '%d1%'")).select("fullFileName", "fileName", "directory", "fileType")


# writes


def totals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(nr, value) of the orders' lines together, and of the orders, some of which have no line."""
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("nr")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("value"))
    return lines, read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("nr"), F.floor("o_totalprice").alias("value"))


@query
def upsert_keep_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = totals(spark, sf_dir)
    return writes.keep_existing(lines, orders, ["nr"])


@query
def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = totals(spark, sf_dir)
    return writes.replace(orders, lines, ["nr"])


@query
def upsert_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with what their lines say last; returned lines say nothing."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("nr"), F.floor("o_totalprice").alias("value"), F.col("o_orderstatus").alias("status"))
    new = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("nr"), F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("bigint")).alias("value"), line_order().alias("line"))
    return writes.upsert(orders, new, ["nr"], "line").select("nr", "value", "status", "line")


@query
def bucket_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in a table of buckets; then lines change them, returned ones delete them, and the first batch comes again. With the counts by status beside."""
    root = versions.scratch(spark, "buckets")
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("nr"), F.floor("o_totalprice").alias("value"), F.col("o_orderstatus").alias("status"), F.lit(0).cast("bigint").alias("line"), F.lit(False).alias("gone"))
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("nr"), F.col("l_quantity").cast("bigint").alias("value"), F.when(F.col("l_linestatus") == "O", "L").alias("status"), line_order().alias("line"), (F.col("l_returnflag") == "R").alias("gone"))
    for version, batch in enumerate((orders, lines)):
        buckets.apply(batch, root, ["nr"], "line", version, "gone", ["status"])
    buckets.apply(orders, root, ["nr"], "line", 0, "gone", ["status"])
    counted = buckets.counts(spark, root).select(F.col("status").alias("s"), F.col("n").alias("status_rows"))
    return buckets.read(spark, root).join(F.broadcast(counted), F.col("status").eqNullSafe(F.col("s")), "left").select("nr", "value", "status", "line", "status_rows")


@query
def published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and the sums of their lines published together, the sums replaced by ones made from the version before."""
    root = versions.scratch(spark, "published")
    lines, orders = totals(spark, sf_dir)
    versions.publish({"orders": orders, "lines": lines}, root)
    versions.publish({"lines": versions.published(spark, root, "lines").select("nr", (F.col("value") * 2).alias("value"))}, root)
    now, first = versions.published(spark, root, "lines"), versions.published(spark, root, "lines", 0)
    return versions.published(spark, root, "orders").join(now.withColumnRenamed("value", "doubled"), "nr", "left").join(first.withColumnRenamed("value", "first"), "nr", "left")


@query
def export_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and orders written as CSV files, with quotes and line breaks in their texts, and read back as exports."""
    root = versions.scratch(spark, "exports")
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("text"), "o_orderstatus")
    for name, df in (("DC1/documents", docs), ("DC2/orders", orders)):
        plain = df.write.option("header", True).option("escape", '"').option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        plain.csv(f"{root}/{name}")
    data = staging.read_exports(spark, f"{root}/*/*/*.csv", "Proef", "2024-01-01 00:00:00", least_rows=1).select("projectcd", "mdbfile", "data")
    entry = lambda name: F.try_element_at("data", F.lit(name))
    number = F.coalesce(entry("doc_id"), entry("o_orderkey")).cast("bigint")
    return data.select("projectcd", "mdbfile", number.alias("nr"), F.size("data").cast("bigint").alias("n_values"), F.length(entry("text")).cast("bigint").alias("n_chars"), F.md5(entry("text").cast("binary")).alias("digest"))


@query
def load_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("string").alias("c_acctbal"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("c_name"), "c_mktsegment")
    return tables.conformed(customer, "c_custkey int, c_acctbal int, c_name varchar(12), absent string, c_mktsegment string").select(F.col("c_custkey").cast("bigint").alias("c_custkey"), F.col("c_acctbal").cast("bigint").alias("c_acctbal"), "c_name", "c_mktsegment")


@query
def export_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an export, written with quotes, read back value by value."""
    line = F.concat(F.lit('"'), F.replace("p_name", F.lit("e"), F.lit('""')), F.lit(', "'), F.lit(","), F.col("p_partkey").cast("string"), F.lit(',"a\n'), F.col("p_type"), F.lit('",'))
    cells = staging.fields(staging.guarded(line))
    return read(spark, sf_dir, "part").select("p_partkey", *[F.get(cells, F.lit(k)).alias(f"c{k}") for k in range(4)], F.size(cells).cast("bigint").alias("n"))


# nested values


@query
def lookup_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the list of their labels, empty for those without."""
    docs = read(spark, sf_dir, "documents").select("doc_id")
    found = references.lookup(docs, "doc_id", read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id", "labels")
    return found.select("doc_id", joined(F.transform("labels", lambda x: F.concat_ws("/", x.quality.cast("string"), x.toxic.cast("string")))).alias("labels"), F.size("labels").cast("bigint").alias("n"))


@query
def nested_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each order as maps without the line's number and without what says nothing."""
    entry = F.create_map(F.lit("nr"), F.col("l_linenumber").cast("string"), F.lit("flag"), F.col("l_returnflag"), F.lit("status"), F.when(F.col("l_quantity") > 10, F.col("l_linestatus")))
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(entry).alias("lines"))
    clean = references.without_in_list(F.col("lines"), ("nr",), ("N",))
    return rows.select("l_orderkey", F.aggregate(clean, F.lit(0).cast("bigint"), lambda n, m: n + F.size(m)).alias("entries"), joined(F.array_sort(F.flatten(F.transform(clean, F.map_values)))).alias("told"))


@query
def list_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("['"), F.replace("p_type", F.lit(" "), F.lit("', '")), F.lit("', "), F.col("p_size").cast("string"), F.lit("]"))
    return read(spark, sf_dir, "part").select("p_partkey", F.explode(staging.list_items(text)).alias("item"))


@query
def remarks_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select("p_brand", F.split("p_type", " ").alias("words"), "p_name")
    return reports.remarked(part, "p_brand", "words", "p_name").select("p_brand", joined(F.col("items")).alias("items"), "remarks")


@query
def outline_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose list of ancestors holds a given one."""
    part = read(spark, sf_dir, "part").select("p_partkey", F.array("p_brand", "p_name", "p_type").alias("uris"))
    return hierarchy.within(part, "uris", F.lit("Brand#13")).select("p_partkey")


@query
def table_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = F.concat(F.when(F.col("p_size") > 25, "Spijkers_").otherwise("Vondst_"), F.col("p_brand"))
    return read(spark, sf_dir, "part").groupBy(values.table_type(table).alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query
def described_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of text for each order, and a suggested column name."""
    orders = read(spark, sf_dir, "orders")
    return orders.select("o_orderkey", values.described("order", nr=F.col("o_orderkey"), klant=F.nullif(F.col("o_custkey"), F.lit(1)), **{"": F.col("o_orderstatus")}).alias("label"), values.short_name(F.concat("o_orderstatus", F.lit(" Vondstnummer"))).alias("name"))




@query
def explode_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = merge.lineage_set(read(spark, sf_dir, "lineitem"), ["l_partkey"], ["l_returnflag", "l_linestatus"])
    return sets.select("l_partkey", F.explode("lineage").alias("w")).select("l_partkey", "w.l_returnflag", "w.l_linestatus")


@query
def json_recordset(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("pk"), F.col("n_name").alias("name"))))).alias("hits"))
    return views.from_json_rows(hits, "hits", "pk: bigint, name: string")


@query
def nested_map_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staging.from_table(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), "orders", "o_orderkey")
    clean = harmonise.without_sentinels(rows.select("_seq", "data"), ["data"], ("F", "5-LOW"))
    return clean.select(F.col("_seq").alias("o_orderkey"), joined(F.array_sort(F.map_keys("data"))).alias("names"))


# trees


def tree_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, their nations and the nations' suppliers as a tree."""
    region = read(spark, sf_dir, "region").select((F.col("r_regionkey") + 1).cast("bigint").alias("primary_key"), F.lit(0).cast("bigint").alias("parentID"), F.col("r_name").alias("concept"))
    nation = read(spark, sf_dir, "nation").select((F.col("n_nationkey") + 100).cast("bigint").alias("primary_key"), (F.col("n_regionkey") + 1).cast("bigint").alias("parentID"), F.col("n_name").alias("concept"))
    supplier = read(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1000).cast("bigint").alias("primary_key"), (F.col("s_nationkey") + 100).cast("bigint").alias("parentID"), F.col("s_name").alias("concept"))
    return region.unionByName(nation).unionByName(supplier)


@query
def hierarchy_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.descendants(tree_of(spark, sf_dir), F.col("concept") == "ASIA").select("primary_key", "concept", F.col("depth").cast("bigint").alias("depth"))


@query
def hierarchy_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") + 100).cast("bigint").alias("ref"))
    return hierarchy.below(customer, "ref", tree_of(spark, sf_dir), F.col("concept") == "EUROPE")


@query
def hierarchy_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole tree with the places of its nodes."""
    return intervals.numbered(tree_of(spark, sf_dir)).select("primary_key", "first", "last", F.col("depth").cast("bigint").alias("depth"))


@query
def hierarchy_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose supplier lies below two regions, by ranges of places."""
    numbers = hierarchy.written(intervals.numbered(tree_of(spark, sf_dir)))
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") + 1000).cast("bigint").alias("ref"))
    placed = intervals.located(line, "ref", numbers)
    below = intervals.below(placed, "place", numbers, F.col("concept").isin("EUROPE", "ASIA"))
    return below.groupBy("ref").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("orders"))


@query
def hierarchy_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.children(tree_of(spark, sf_dir), 2).select("primary_key", "concept")


@query
def hierarchy_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.with_parent(tree_of(spark, sf_dir), ["concept"]).select("primary_key", "concept", "parent_concept")


@query
def outline_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as an indented list of brands: every tenth part opens a group, every third a group within it."""
    k = F.col("p_partkey")
    listed = read(spark, sf_dir, "part").select("p_partkey", "p_brand", F.when(k % 10 == 0, k.cast("string")).alias("l0"), F.when((k % 10 != 0) & (k % 3 == 0), k.cast("string")).alias("l1"), F.when((k % 10 != 0) & (k % 3 != 0), k.cast("string")).alias("l2"))
    out = outline.outline_paths(listed, ["l0", "l1", "l2"], "p_partkey", "p_brand")
    return out.select("p_partkey", F.array_join("uris", "/").alias("uris"), "parent_uri")


@query
def outline_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as one indented list without schemes: every 500th key opens a group, every tenth a group within it."""
    k = F.col("o_orderkey")
    name = k.cast("string")
    listed = read(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 500 == 0, name).alias("l0"), F.when((k % 500 != 0) & (k % 10 == 0), name).alias("l1"), F.when(k % 10 != 0, name).alias("l2"))
    out = outline.outline_paths(listed, ["l0", "l1", "l2"], "o_orderkey", rows=10_000)
    return out.select("o_orderkey", F.array_join("uris", "/").alias("uris"), "parent_uri")


# search


@query
def fulltext_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    hits = search.ranked_rows(docs, "doc_id", ["text"], "the license")
    return hits.select(F.col("pk").alias("doc_id"), F.round("score", 6).alias("score"))


@query
def fulltext_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with all words, without a word, by a word's beginning and by field."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    hits = search.ranked(search.postings(part, "p_partkey", ["p_name", "p_type"]), "p_type:eco* AND NOT red")
    return hits.select(F.col("pk").alias("p_partkey"))


@query
def fulltext_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("primary_key"), "text", "lang")
    hits = search.search(docs, "primary_key", "license", ["text"], F.col("lang") == "en", 10)
    return hits.select("primary_key", F.round("fulltext_score", 6).alias("score"), (F.length("highlight") - F.length(F.replace("highlight", F.lit("<mark>"), F.lit("")))).cast("bigint").alias("marks"))


@query
def postings_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    changed = part.where("p_partkey % 10 = 0").withColumn("p_type", F.concat("p_type", F.lit(" nieuw nieuw")))
    index = search.reindexed(search.postings(part, "p_partkey", ["p_type"], "part"), changed, "p_partkey", ["p_type"], "part")
    return index.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("tf").alias("tf"))


@query
def fulltext_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with a phrase beside another word: only words that stand one after the other are the phrase, and it counts as often as they do."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    hits = search.search(part, "p_partkey", '"anodized steel" OR promo* -"plated tin"', ["p_type"], limit=None)
    return hits.select("p_partkey", F.round("fulltext_score", 6).alias("score"))


@query
def fulltext_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in an index of segments; a later batch changes those of one language, the next deletes junk ones. A phrase and a word ranked from it."""
    root = versions.scratch(spark, "segments")
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    labels = read(spark, sf_dir, "labels").where("quality = 0").select("doc_id", F.lit("").alias("text"), F.lit(True).alias("gone"))
    batches = [docs.select("doc_id", "text", F.lit(False).alias("gone")), docs.where("lang <> 'en'").select("doc_id", F.concat(F.lit("the license "), "text").alias("text"), F.lit(False).alias("gone")), labels]
    for version, batch in enumerate(batches):
        segments.apply(batch, root, "doc_id", ["text"], version, "documents", "gone")
    hits = segments.ranked(spark, root, '"the license" software')
    return hits.select(F.col("pk").alias("doc_id"), F.round("score", 6).alias("score"))


# dates by context


@query
def dating_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 3).alias("a"), (F.col("l_suppkey") % 2).alias("b"), F.col("l_quantity").cast("bigint").alias("c"))
    return line.select("l_orderkey", "l_linenumber", references.precedence(F.col("a"), F.col("b"), F.col("c")).alias("vanaf"))


@query
def dating_denormalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("vondstID"), F.col("l_linenumber").cast("bigint").alias("nr"), F.col("l_partkey").alias("artefactdatering_vanaf"), F.col("l_suppkey").alias("artefactdatering_tot"))
    finds = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("primary_key"), F.col("o_custkey").alias("spoorID"), F.year("o_orderdate").cast("bigint").alias("vondstdatering_vanaf"), F.month("o_orderdate").cast("bigint").alias("vondstdatering_tot"))
    traces = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("primary_key"), F.col("c_nationkey").cast("bigint").alias("spoordatering_vanaf"), F.lit(7).cast("bigint").alias("spoordatering_tot"))
    return views.dated_by_context(line, finds, traces)
