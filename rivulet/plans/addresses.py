"""Addresses: history, parsing, geocoding, one normal form."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rivulet.catalog import Catalog
from rivulet.contracts import ENTITY, as_columns
from rivulet.durable import stored
from rivulet.functions.text import clean, repeated_word, separators
from rivulet.operators.asof import asof_join
from rivulet.operators.audit import reconstruct
from rivulet.operators.debounce import debounce
from rivulet.operators.fill import fill_nulls
from rivulet.operators.memo import memoised, memoised_frame
from rivulet.operators.region import Region
from rivulet.sources.geocoders import Pace, Service, cascade

COLUMNS = ("street1", "street2", "city", "state", "postal_code", "country")
PARSED = ("house_number", "road", "unit", "house", "po_box", "city", "state", "country", "postcode")
#: Parser components that make up each of PARSED, in order.
GROUPS = {
    "house_number": ("house_number",),
    "road": ("road",),
    "unit": ("level", "entrance", "staircase", "unit"),
    "house": ("house", "category", "near"),
    "po_box": ("po_box",),
    "city": ("suburb", "city_district", "city", "island"),
    "state": ("state_district", "state"),
    "country": ("country_region", "country", "world_region"),
    "postcode": ("postcode",),
}
#: Components joined by a comma; the others by a space.
LISTED = ("city", "state", "country")
#: Fixed values, secondary unit designators of the United States Postal Service's Publication 28, appendix C2: those that stand alone, and those
#: that a number follows.
UNIT_ALONE = "basement bsmt floor fl front frnt lobby lbby lowr office ofc penthouse ph rear uppr".split()
UNIT_NUMBERED = "apartment apt building bldg department dept hanger hngr key lot pier room rm slip space spc stop suite ste trailer trlr unit".split()
#: Fixed values, names of streets of the same publication's appendix C1; those that have a plural there, too.
STREET_NAMES = (
    "alley annex arcade avenue bayou beach bend bottom boulevard branch bypass camp canyon cape causeway club corner crescent crest crossing curve dam divide "
    "expressway ferry forest fort freeway gateway haven heights highway hollow inlet isle junction lake land landing loop mall meadow mission motorway neck orchard oval "
    "overpass parkway passage path pike pine plain plaza prairie radial ramp ranch rapid rest ridge river row rue run skyway spur square station stravenue stream "
    "street summit terrace throughway trace track trafficway trailer tunnel turnpike underpass valley viaduct view village ville vista walk wall way"
).split()
STREET_PLURALS = (
    "bluff brook burg center circle cliff common corner course court cove creek dale drive estate extension fall field flat ford forge fork garden glen green grove "
    "harbor hill island key knoll lake light loaf lock lodge manor meadow mews mill mount mountain park parkway pass path pine plain point port ranch rapid ridge road "
    "route shoal shore spring spur square street summit terrace throughway trail union valley view village walk way well"
).split()
#: Short forms of the same appendix that the rule below doesn't give.
STREET_SHORT = (
    "aly anx arc av ave aven avn bch bg blvd boul bot br brdge bnd byp bypa bypas byu cen cent ctr centre cir circ cmn cnter cor cp cpe crcle cres crscnt cswy ct cts cv cyn dl "
    "dm dr driv drv dv est ests exp expr expw expy ext exts fld flds fls frd frg frk frks frry frst frt frwy ft fwy gdn gdns gln grn grov grv gtwy harb hbr highwy hiway hiwy "
    "hl hllw hls holw ht hts hvn hway hwy inlt is iss isls jct jctn jctns keys kys knl knls knol la ldg ldge lf lgt lgts lk lks ln lndg mdw mdws ml mls mnr mnrs mntn msn mssn mt mtn mtwy "
    "nck opas orch ovl paths pikes pkwy pkwys pky pl plz plza pne pnes pr prk prts psge pt pts rad ranchs rd rdg rdge rdgs rds riv rnch rnchs rpd rpds rst rte shl shls shr shrs skwy "
    "smt spg spgs spurs sq sqr sqre sqrs sqs st sta statn stn str stra strm strt sts sumit ter terr tpke trak trce trfy trk trks trl trlr trls trnpk trwy tunl un uns upas vdct via vis vist "
    "vl vlg vlgs vlly vly vlys vst vsta vw vws wl wls wy xing xrd xrds"
).split()


def _short(name: str) -> str:
    """A name's first letter and its further consonants, one of a pair: crk of creek, blf of bluff."""
    return name[0] + re.sub(r"(.)\1", r"\1", re.sub("[aeiou]", "", name[1:]))


#: Endings of streets; give others as `streets`.
STREETS = sorted({w for n in (*STREET_NAMES, *STREET_PLURALS, *(f"{n}s" for n in STREET_PLURALS)) for w in (n, _short(n)) if len(w) > 1} | {*STREET_SHORT, "lane", "place", "allee", "crossroad", "crossroads"})
#: Directions, in English and Spanish.
DIRECTIONS = "n ne nw s se sw e w norte noreste noroeste sur sureste suroeste este oeste north northeast northwest south southeast southwest east west".split()
UNIT_NUMBER = r"(?:\d[\d\w]*|\w\d+|ph.{1,3})"
_UNIT = "(?:" + "|".join([*UNIT_ALONE, *(f"{w}(?!$)" for w in UNIT_NUMBERED), "#(?!$)"]) + ")"
#: A line that is a unit's number, with its designator or without.
UNIT_LINE = rf"^{_UNIT}?\s*{UNIT_NUMBER}$"


def unit_after_street(streets: Sequence[str] = STREETS) -> str:
    """Pattern whose first group is what follows a street's suffix (and direction) if that begins as a unit does."""
    return rf"\W+(?:{'|'.join(streets)})\W+(?:(?:{'|'.join(DIRECTIONS)})\W+)?((?:{_UNIT}|{UNIT_NUMBER}).*)$"


PREFIX = "parsed."
Parser = Callable[[list[str]], list[dict[str, str]]]


def history(audit: DataFrame, base: DataFrame, key: str = "address_no", columns: Sequence[str] = (*COLUMNS, "primary_ind")) -> DataFrame:
    """One row per address and day: its last state of the day by time, of the states that the address goes through."""
    rows = reconstruct(audit, base, key, {c: c for c in columns}).withColumnRenamed("timestamp", "_time")
    rows = rows.withColumn("timestamp", F.to_date("_time"))
    last = debounce(rows, [key, "timestamp"], ["_time"])  # a state for each time
    return last.select(key, "timestamp", *(c for c in rows.columns if c not in (key, "timestamp", "_time")))


def raw_parse(parser: Parser) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A memo function: joins the address columns, lower case, and gives the parser's components as JSON."""

    def run(keys: pd.DataFrame) -> pd.DataFrame:
        texts = [", ".join(str(x) for x in row if isinstance(x, str) and x) for row in keys[list(COLUMNS)].itertuples(index=False)]
        return pd.DataFrame({"components": [json.dumps(x) for x in parser([t.lower() for t in texts])]})

    return run


def repaired(df: DataFrame, components: str = "components", streets: Sequence[str] = STREETS) -> DataFrame:
    """df with PREFIX columns of its parser components: groups united. A missing unit is, in this order, a postcode that isn't
    the one given, a second street line that is a unit's number, or what follows the street in the road; a unit is
    taken out of postcode, road and house where it stands there as a whole; blanks null."""
    said = F.from_json(F.col(components), "map<string,string>")
    sep = lambda k: ", " if k in LISTED else " "
    df = df.withColumns({f"_{k}": F.concat_ws(sep(k), *(F.try_element_at(said, F.lit(g)) for g in group)) for k, group in GROUPS.items()})
    line = F.lower(F.col("street2"))
    tail = F.regexp_extract("_road", unit_after_street(streets), 1)
    unit = (
        F.when(F.trim("_unit") != "", F.col("_unit"))
        .when((F.col("_postcode") != "") & (F.col("_postcode") != F.lower("postal_code")), F.col("_postcode"))
        .when(line.rlike(UNIT_LINE), line)
        .when(tail != "", tail)
        .otherwise(F.lit(""))
    )
    df = df.withColumn("_unit", F.trim(unit))
    # quoted, so that a unit's own marks aren't a pattern's
    found = F.concat(F.lit(r"(^|\W+)\Q"), F.col("_unit"), F.lit(r"\E(\W+|$)"))
    without = lambda c: F.when(F.col("_unit") != "", F.expr(f"regexp_replace(`{c}`, `_found`, '', 1)")).otherwise(F.col(c))
    df = df.withColumn("_found", found)
    out = {PREFIX + k: F.nullif(without(f"_{k}") if k in ("postcode", "road", "house") else F.trim(f"_{k}"), F.lit("")) for k in PARSED}
    return df.withColumns(out).drop("_found", *(f"_{k}" for k in PARSED))


def parse(df: DataFrame, parser: Parser, catalog: Catalog, name: str = "address_parse", chunk: int = 1000) -> DataFrame:
    """df with parsed columns; only addresses not seen before go to the parser."""
    return repaired(memoised(df, COLUMNS, raw_parse(parser), "components string", catalog, name, chunk)).drop("components")


GEO = "service string, query string, lat double, lon double, matched_address string, formatted_address string, location_type string, tract string"


def street_expressions(df: DataFrame) -> dict[str, Column]:
    """What services are asked for: the parsed street, the first and the second line, each with city, state, post code and country;
    null where that is blank or the same as one before, and where the address has nothing but blanks."""
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    parsed = [filled(F.col(f"`{PREFIX}{c}`")) for c in ("house_number", "road", "house") if PREFIX + c in df.columns]
    street = {"parsed": F.concat_ws(" ", *parsed)} if parsed else {}
    street |= {c: F.col(c) for c in COLUMNS[:2]}
    some = F.concat_ws("", *(filled(x) for x in street.values()), *(filled(F.col(c)) for c in COLUMNS[2:])) != ""
    out: dict[str, Column] = {}
    for name, line in street.items():
        text = F.concat_ws(", ", filled(line), *(filled(F.col(c)) for c in COLUMNS[2:]))
        fresh = some & (text != "")
        for before in out.values():
            fresh = fresh & ~text.eqNullSafe(before)
        out[name] = F.when(fresh, text)
    return {f"_ask_{k}": v for k, v in out.items()}


def geocode(df: DataFrame, services: Sequence[Service], catalog: Catalog, name: str = "address_geocode") -> DataFrame:
    """df with the geocoders' columns, one row per row: services in order, within each the street expressions in order; the
    first that finds a place counts. Only addresses not met before are asked for, found or not; those of blanks never are."""
    parsed = [PREFIX + c for c in ("house_number", "road", "house") if PREFIX + c in df.columns]
    fields = StructType.fromDDL(GEO)
    asked = StructType([f for f in fields.fields if f.name not in ("service", "query")])

    def found(keys: DataFrame) -> DataFrame:
        rows = keys.withColumns(street_expressions(keys))
        asks = [c for c in rows.columns if c.startswith("_ask_")]
        rows = stored(rows.withColumn("_key", F.xxhash64(*COLUMNS)).select("_key", *COLUMNS, *asks), "geocode-keys")
        hits = cascade(rows, ["_key", *COLUMNS], asks, services, asked, "lat")
        same = {c: f"_h{i}" for i, c in enumerate(COLUMNS)}
        on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(h)) for c, h in same.items()))
        return rows.drop(*asks).join(hits.drop("_key").withColumnsRenamed(same), on, "left")

    return memoised_frame(df, COLUMNS, found, fields, catalog, name, parsed)


def inside(lat: Column, lon: Column, ring: Sequence[tuple[float, float]]) -> Column:
    """Whether a point lies in a polygon of few corners, given as (lat, lon), by one expression: an odd number of edges to one
    side of it. Points of the edges themselves aren't inside. A region of many corners, of parts or with holes is a `Region`."""
    crossed, on = [], F.lit(False)
    for (a, b), (c, d) in zip(ring, [*ring[1:], ring[0]]):
        on |= lat.between(min(a, c), max(a, c)) & lon.between(min(b, d), max(b, d)) & ((lat - a) * (d - b) == (lon - b) * (c - a))
        if a != c:
            crossed.append((((lat >= min(a, c)) & (lat < max(a, c))) & (lon < (lat - a) * ((d - b) / (c - a)) + b)).cast("int"))
    return (reduce(lambda x, y: x + y, crossed, F.lit(0)) % 2 == 1) & ~on


def reverse_census(df: DataFrame, ask: Callable[[float, float], str | None], country: Region, catalog: Catalog, name: str = "reverse_census", tasks: int = 1, per_second: float | None = None) -> DataFrame:
    """df with tract filled by coordinates where it is missing and they lie in the country; errors leave null. On so many tasks, which
    share the calls a second."""

    def run(keys: pd.DataFrame) -> pd.DataFrame:
        def one(a: float, b: float) -> str | None:
            try:
                return ask(a, b)
            except Exception:  # noqa: BLE001
                return None

        pace = Pace(per_second / tasks if per_second else None)
        out = []
        for a, b in zip(keys["lat"], keys["lon"]):
            pace.wait()
            out.append(one(a, b))
        return pd.DataFrame({"_tract": out}, dtype="object")

    points = df.where("tract is null and lat is not null and lon is not null").select("lat", "lon").distinct()
    some = memoised(country.with_inside(points, "lat", "lon", "_in").where("_in").drop("_in"), ["lat", "lon"], run, "_tract string", catalog, name, parallel=tasks)
    return df.join(some, ["lat", "lon"], "left").withColumn("tract", F.coalesce("tract", "_tract")).drop("_tract").select(*as_columns(df.columns))


def normalised(df: DataFrame) -> DataFrame:
    """df with {column}_cleaned. Each row's first line, city, state, post code and country come from one place: a rooftop match
    of the map service in five parts (its state and post code stand together), else the census's match, else the
    parser, if it found a road, else what was written. The second line is the parser's box, unit or house, unless it
    is the first; a unit that isn't there goes after the first line; a second line that repeats a word gives way to
    the written one. All are cleaned then, states and countries in capitals."""
    parsed = lambda c: F.col(f"`{PREFIX}{c}`")
    formatted = F.regexp_replace("formatted_address", r", ([A-Za-z]+) (\d+), (\w+)$", ", $1, $2, $3")
    census, roof = F.split("matched_address", ", "), F.split(formatted, ", ")
    is_roof = F.coalesce((F.col("location_type") == "ROOFTOP") & (separators(formatted) == 4), F.lit(False))
    part = lambda i: F.when(is_roof, F.get(roof, F.lit(i))).when(F.col("matched_address").isNotNull(), F.get(census, F.lit(i)) if i < 4 else F.lit("USA"))
    names = ("street1", "city", "state", "postal_code", "country")
    of_parser = (F.concat_ws(" ", parsed("house_number"), parsed("road")), parsed("city"), parsed("state"), parsed("postcode"), parsed("country"))
    known, road = part(0).isNotNull(), parsed("road").isNotNull()
    df = df.withColumns({f"_{n}": F.when(known, part(i)).when(road, of_parser[i]).otherwise(F.col(n)) for i, n in enumerate(names)})
    other = F.coalesce(parsed("po_box"), parsed("unit"), parsed("house"))
    df = df.withColumn("_street2", F.when(F.col("_street1") != other, other))
    df = df.withColumn("_street1", F.when(parsed("unit").isNotNull() & (F.col("_street2") != parsed("unit")), F.concat_ws(", ", "_street1", parsed("unit"))).otherwise(F.col("_street1")))
    df = _unrepeated(df, "_street1", "_street2")
    upper = ("state", "country")
    return df.withColumns({f"{n}_cleaned": F.upper(clean(F.col(f"_{n}"))) if n in upper else clean(F.col(f"_{n}")) for n in (*names[:1], "street2", *names[1:])}).drop("_street2", *(f"_{n}" for n in names))


def _unrepeated(df: DataFrame, first: str, second: str) -> DataFrame:
    """A second line that has a word twice becomes the written one, unless that is the first."""
    twice = F.coalesce(repeated_word(F.col(second)), F.lit(False)) & (clean(F.col("street2")) != F.col(first))
    return df.withColumn(second, F.when(twice, clean(F.col("street2"))).otherwise(F.col(second)))


def street_cleaner(members: DataFrame, addresses: DataFrame, salutations: DataFrame) -> DataFrame:
    """The latest primary address of each member of a list, normal, with its salutation and flags: repeated_word (in both lines
    together) and possible_duplicate (another member has the same lines, city and state)."""
    rows = addresses.join(members.select("customer_no").distinct(), "customer_no", "left_semi").where("primary_ind = 'Y'")
    rows = normalised(debounce(rows, ["customer_no"], ["timestamp", "address_no"])).join(salutations.dropDuplicates(["customer_no"]), "customer_no", "left")
    rows = _unrepeated(rows, "street1_cleaned", "street2_cleaned")
    keys = ["street1_cleaned", "street2_cleaned", "city_cleaned", "state_cleaned"]
    alike = F.count("*").over(Window.partitionBy(*keys))
    return rows.withColumns({"possible_duplicate": alike > 1, "repeated_word": repeated_word(F.concat_ws(" ", "street1_cleaned", "street2_cleaned"))})


#: A score table's columns, and what the stream calls them.
SCORES = {
    "pro_score": "address_pro_score_level",
    "capacity_value": "address_capacity_level",
    "properties_total_value": "address_properties_level",
    "donations_total_value": "address_donations_level",
}


def build(addresses: DataFrame, enriched: Sequence[DataFrame], scores: DataFrame, score_cols: Mapping[str, str] = SCORES, tie: Sequence[str] = ()) -> DataFrame:
    """addresses joined with frames of further columns by (address_no, timestamp), with event_type and scores.

    scores: household, score_dt and the keys of score_cols, which tells their names. A score belongs to the household's address
    rows nearest to it in time (the earlier, at equal distances; all rows of that time); of several the last by
    score_dt and tie counts. Scores, and nothing else, are filled forward within the household."""
    for more in enriched:
        addresses = addresses.join(more, ["address_no", "timestamp"], "left")
    times = addresses.select(ENTITY, F.col("timestamp").alias("_near")).distinct()
    placed = asof_join(scores, times, [ENTITY], "score_dt", "_near", ["_near"], "nearest").where("_near is not null")
    last = debounce(placed, [ENTITY, "_near"], ["score_dt", *tie])
    last = last.select(F.col(ENTITY).alias("_home"), "_near", *(F.col(a).alias(b) for a, b in score_cols.items()))
    out = addresses.join(last, (F.col(ENTITY) == F.col("_home")) & (F.col("timestamp") == F.col("_near")), "left").drop("_home", "_near")
    return fill_nulls(out.withColumn("event_type", F.lit("Address")), "locf", list(score_cols.values()), [ENTITY], ["timestamp", "address_no"])


def address_stream(catalog: Catalog, built: DataFrame, slim: Sequence[str], least_household: int = 200) -> DataFrame:
    """Writes all rows, and of the primary addresses (and score rows) of real households the slim columns."""
    catalog.overwrite("address_stream_full", built)
    rows = catalog.read("address_stream_full")
    scored = F.coalesce(F.col("event_subtype") == "iWave Score", F.lit(False)) if "event_subtype" in rows.columns else F.lit(False)
    kept = rows.where((F.coalesce(F.col("primary_ind") == "Y", F.lit(False)) | scored) & (F.col(ENTITY) >= least_household))
    return catalog.overwrite("address_stream", kept.select(*slim))
