"""Plans: increments equal full builds, and golden cases."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.catalog import Catalog
from rivulet.plans import addresses, census, contributions, duplicates, email, marketing, surveys, unified
from rivulet.operators.region import Region
from rivulet.sources import rest
from rivulet.sources.geocoders import Service, one_by_one
from rivulet.sources.workbooks import xlsx, xlsx_cells
from rivulet.sources.resilient import resilient
from rivulet.sources.tables import Tables
from rivulet.streaming.incremental import follow, late_counts

D0 = datetime(2023, 1, 1)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def streams(spark):
    a = spark.createDataFrame([(i % 7, D0 + timedelta(days=i * 3), float(i)) for i in range(90)], "group_customer_no int, timestamp timestamp_ntz, feature_a double")
    b = spark.createDataFrame([(i % 7, (D0 + timedelta(days=i * 2)).date(), float(-i), i) for i in range(120)], "group_customer_no int, timestamp date, feature_b double, pk int")
    return a, b


def test_chunks_equal_full(spark, streams, tmp_path):
    a, b = streams
    cut = "2023-05-01"
    whole, parts = Catalog(spark, str(tmp_path / "w")), Catalog(spark, str(tmp_path / "p"))
    build = lambda c: unified.stream(c, ["a", "b"], fill_match=["^feature"], window_match=["_a$", "_b$"], windows=(1, 30, 400), tie=["stream"])
    whole.overwrite("a", a), whole.overwrite("b", b)
    full = build(whole)
    parts.overwrite("a", a.where(F.col("timestamp") < cut)), parts.overwrite("b", b.where(F.col("timestamp") < cut))
    build(parts)
    parts.overwrite("a", a), parts.overwrite("b", b)
    done = build(parts)
    cols = ["group_customer_no", "timestamp", "stream", "feature_a", "feature_b", "pk", "timestamp_id", *(f"`feature_{x}.-{d}`" for x in "ab" for d in (1, 30, 400))]
    assert done.count() == 210 and rows(done, *cols) == rows(full, *cols)
    assert rows(build(parts), *cols) == rows(full, *cols)


@pytest.fixture(scope="module")
def mail(spark):
    promos = spark.createDataFrame([(3, i % 9, i % 9 + 100, D0 + timedelta(days=i), i % 3, i % 4, i % 11, " A%d@X.org " % i if i % 5 == 0 else None) for i in range(80)] + [(1, 1, 101, D0, 1, 1, 1, "no")], "media_type int, customer_no int, group_customer_no int, promote_dt timestamp_ntz, appeal_no int, campaign_no int, source_no int, eaddress string")
    replies = spark.createDataFrame([(i % 9 + 100, i % 9, i % 5 + 1, D0 + timedelta(days=i, hours=2), i % 11) for i in range(0, 80, 3)], "group_customer_no int, customer_no int, response int, response_dt timestamp_ntz, source_no int")
    codes = spark.createDataFrame([(1, "Opened e-mail"), (2, "CLICKED"), (3, "Unsubscribed"), (4, "soft"), (5, "Other")], "response int, event_subtype string")
    sources = spark.createDataFrame([(i, f"s{i}", D0) for i in range(11)], "source_no int, source_desc string, acq_dt timestamp_ntz")
    extractions = spark.createDataFrame([(i, f"x{i}") for i in range(5)], "source_no int, extraction_desc string")
    emails = spark.createDataFrame([(c, c + 100, "Y", D0 - timedelta(days=9), f"C{c}@y.com") for c in range(9)] + [(1, 101, "Y", D0 + timedelta(days=20), "new@y.com")], "customer_no int, group_customer_no int, primary_ind string, timestamp timestamp_ntz, address string")
    return lambda a, b: email.base(promos, replies, codes, sources, extractions, emails, a, b)


def test_email(spark, mail, tmp_path):
    out = mail("2023-01-01", "2024-01-01")
    assert {r[0] for r in out.select("event_subtype").distinct().collect()} == {"Send", "Open", "Click", "Unsubscribe", "Soft Bounce", "Other"}
    assert out.where("eaddress <> lower(trim(eaddress))").count() == 0 and out.where("domain not in ('x.org', 'y.com')").count() == 0
    assert mail("1990-01-01", "1990-02-01").count() == 0
    kinds = ("Send", "Open", "Click")
    c, p = Catalog(spark, str(tmp_path / "c")), Catalog(spark, str(tmp_path / "p"))
    full = email.email_stream(c, out, subtypes=kinds)
    for a, b in (("2023-01-01", "2023-02-10"), ("2023-02-10", "2024-01-01")):
        part = out.where((F.col("timestamp") >= F.lit(a).cast("timestamp_ntz")) & (F.col("timestamp") < F.lit(b).cast("timestamp_ntz")))
        done = email.email_stream(p, part, subtypes=kinds)
    cols = ["group_customer_no", "timestamp", "event_subtype", *(f"email_{k.lower()}_{x}" for k in kinds for x in ("count", "timestamp_min", "timestamp_max"))]
    assert rows(done, *cols) == rows(full, *cols)


def test_marketing(spark, tmp_path):
    contacts = spark.createDataFrame([(str(i), f" U{i}@z.com ") for i in range(20)], "id string, email string")
    fields = spark.createDataFrame([(str(i), str(i), "1", str(i)) for i in range(15)], "id string, contact string, field string, value string")
    homes = spark.createDataFrame([(i, i % 5) for i in range(30)], "customer_no int, group_customer_no int")
    lists = spark.createDataFrame([(str(i), "2023-01-05T00:00:00Z", str(1 + (i % 3 == 2)), str(i % 20), "7", "8", "9") for i in range(40)], "id string, updated_timestamp string, status string, contact string, campaign string, message string, list string")
    crm = spark.createDataFrame([(i, f"u{i}@Z.com", i % 5) for i in range(10)], "customer_no int, address string, group_customer_no int")
    m = marketing.email_map(crm, contacts, fields, homes)
    assert m.count() == 15 and m.where("email <> lower(email)").count() == 0
    out = marketing.orphans(contacts, fields, lists, homes, crm)
    assert {int(r["id"]) for r in out.collect()} <= set(range(10, 15)) and out.count() > 0
    logs = spark.createDataFrame([("1", "1672531200", "3", "7", "8")], "id string, tstamp string, subscriberid string, campaignid string, messageid string")
    links = spark.createDataFrame([("1", "1672531300", "3", "7", "8", "5", "0"), ("2", "1672531300", "3", "7", "0", "5", "1"), ("3", "1672531301", "3", "7", "8", "5", "1")], "id string, tstamp string, subscriberid string, campaignid string, messageid string, link string, isread string")
    bounces = spark.createDataFrame([("1", "1672531400", "3", "x"), ("2", "1672531400", "3", "")], "id string, tstamp string, subscriberid string, email string")
    names = {k: spark.createDataFrame([(i, f"{k}{i}")], "id string, name string") for k, i in (("campaigns", "7"), ("messages", "8"), ("links", "5"), ("lists", "9"))}
    tables = {"logs": logs, "linkData": links, "mppLinkData": links.limit(0), "bounceLogs": bounces, "contactLists": lists, **names}
    done = marketing.marketing_stream(Catalog(spark, str(tmp_path)), tables, m)
    kinds = {r["event_subtype"]: r["count"] for r in done.groupBy("event_subtype").count().collect()}
    assert kinds["Send"] == kinds["Open"] == kinds["Click"] == kinds["Soft Bounce"] == 1 and kinds["Unsubscribe"] == 13
    assert done.where("event_subtype = 'Click'").first()["link_name"] == "links5" and done.where("event_subtype = 'Send'").first()["timestamp"] == D0


def test_changed_emails(spark):
    s = "customer_no int, group_customer_no int, eaddress_no int, timestamp timestamp_ntz, primary_ind string, inactive string, address string, last_updated_by string"
    t = lambda n: D0 + timedelta(days=n)
    df = spark.createDataFrame([
        (1, 1, 10, t(0), "Y", "N", "old@a.com", "x"), (1, 1, 10, t(5), "Y", "N", "new@a.com", "me"),  # changed in place
        (2, 2, 20, t(0), "Y", "N", "one@b.com", "x"), (2, 2, 20, t(6), "N", "N", "one@b.com", "you"), (2, 2, 21, t(6), "Y", "N", "two@b.com", "you"),  # replaced
        (3, 3, 30, t(0), "Y", "N", "same@c.com", "x"),
        (4, 4, 40, t(0), "Y", "N", "a@x", "x"), (4, 4, 40, t(1), "Y", "N", None, "x"), (4, 4, 40, t(2), "Y", "N", "b@x", "she"),  # a null between
        (None, None, 50, t(0), "Y", "N", "n1@x", "x"), (None, None, 51, t(2), "Y", "N", "n2@x", "x"),  # nobody's
    ], s)
    out = marketing.changed_emails(df, D0, t(100))
    assert rows(out, "from", "to", "last_updated_by") == [("a@x", "b@x", "she"), ("old@a.com", "new@a.com", "me"), ("one@b.com", "two@b.com", "you")]
    assert marketing.changed_emails(df, t(50), t(100)).count() == 0


def test_contributions(spark):
    c = spark.createDataFrame([(1, 10, 100, 1, 5.0, D0, D0), (2, 10, 100, 1, 6.0, D0 + timedelta(30), D0 + timedelta(30)), (3, 11, 110, 1, 0.0, D0, D0)], "ref_no int, customer_no int, group_customer_no int, campaign_no int, cont_amt double, create_dt timestamp_ntz, cont_dt timestamp_ntz")
    links = spark.createDataFrame([(1, 77)], "ref_no int, cust_memb_no int")
    credit = spark.createDataFrame([(2, 12), (3, 13)], "ref_no int, creditee_no int")  # 13 has no household
    members = spark.createDataFrame([(77, 1, "L", "Active"), (78, 1, "L", "Cancelled"), (79, 1, "L", None)], "cust_memb_no int, campaign_no int, memb_level string, current_status_desc string")
    pays, m = contributions.load(c, links, credit, members, spark.createDataFrame([(1, "cat")], "campaign_no int, campaign_category_desc string"), spark.createDataFrame([("L", "Level")], "memb_level string, level_desc string"), spark.createDataFrame([(12, 100)], "customer_no int, group_customer_no int"))
    assert rows(pays, "ref_no", "customer_no", "group_customer_no", "cust_memb_no") == [(1, 10, 100, 77), (2, 12, 100, None), (3, 11, 110, None)]
    assert rows(m, "cust_memb_no") == [(77,), (79,)]
    out = contributions.features(pays, [("Gift", F.lit(True))])
    assert rows(out, "ref_no", "contribution_amt", "event_subtype2", "contribution_Gift_count", "contribution_timestamp_max") == [(1, 5.0, "New", 1, D0), (2, 11.0, "Upgrade", 2, D0 + timedelta(30))]


def test_duplicates(spark):
    n = 26
    data = spark.createDataFrame([(i + 1, *(f"{c}{i % n}" for c in "abcd"), None if i % 2 else f"u{i % n}", *(f"{c}{i % n}" for c in "efg")) for i in range(2 * n)], "customer_no int, email string, house_number string, road string, city string, unit string, state string, fname string, lname string")
    homes = spark.createDataFrame([(i, i) for i in range(1, 53)], "customer_no int, group_customer_no int")
    none = spark.createDataFrame([], "customer_no int, associated_customer_no int")
    customers = spark.createDataFrame([(i, i, "Active", D0 if i % 3 else None, D0 + timedelta(i)) for i in range(1, 53)], "customer_no int, group_customer_no int, inactive_desc string, last_activity_dt timestamp_ntz, last_update_dt timestamp_ntz")
    known = duplicates.facts(customers, spark.createDataFrame([(30, "Y", 5.0, "B")], "customer_no int, cur_record_ind string, memb_amt double, memb_level string"), spark.createDataFrame([(2, "N", D0)], "customer_no int, inactive string, last_login_dt timestamp_ntz"))
    out = duplicates.duplicates_stream(data, homes, none, known)
    assert rows(out, "customer_no", "`i.customer_no`") == sorted(((i + n, i) for i in range(1, n + 1)), key=str)
    assert out.where("keep_reason is null").count() == 0
    assert rows(out.where("customer_no = 30"), "keep_customer_no", "delete_customer_no", "keep_reason") == [(30, 4, "Current membership")]


RAW = "street1 string, street2 string, city string, state string, postal_code string, country string"


def test_addresses(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    df = spark.createDataFrame([("12 main st apt 4", None, "town", "ma", "02139", "usa", 1), (None, None, None, None, None, None, 2), ("12 main st apt 4", None, "town", "ma", "02139", "usa", 3)], RAW + ", n int")

    def parser(texts):
        return [{"house_number": "12", "road": "main st apt 4", "city": "town", "state": "ma", "postcode": "02139", "country": "usa"} if t else {} for t in texts]

    out = addresses.parse(df, parser, catalog)
    assert out.count() == 3
    first = out.where("n = 1").first()
    assert (first["parsed.unit"], first["parsed.road"], first["parsed.po_box"]) == ("apt 4", "main st", None)
    service = Service("two", one_by_one(lambda q: {"lat": 1.0, "lon": 2.0, "formatted_address": "12 Main St, Apt 4, Town, MA 02139, USA", "location_type": "ROOFTOP"}))
    found = addresses.geocode(out, [service], catalog)
    assert found.count() == 3 and found.where("n = 2").first()["lat"] is None and found.where("n = 1").first()["query"] == "12 main st, town, ma, 02139, usa"
    square = [(0.0, 0.0), (0.0, 9.0), (9.0, 9.0), (9.0, 0.0)]
    census_ = addresses.reverse_census(found, lambda a, b: f"t{a:g}", Region([square]), catalog)
    assert [r["tract"] for r in census_.orderBy("n").collect()] == ["t1", None, "t1"]
    n = addresses.normalised(found).where("n = 1").first()
    assert (n["street1_cleaned"], n["street2_cleaned"], n["city_cleaned"], n["state_cleaned"], n["postal_code_cleaned"], n["country_cleaned"]) == ("12 Main St", "Apt 4", "Town", "MA", "02139", "USA")
    people = found.withColumns({"customer_no": F.col("n"), "primary_ind": F.lit("Y"), "timestamp": F.lit(D0), "address_no": F.col("n")})
    flags = addresses.street_cleaner(people.select("customer_no"), people, spark.createDataFrame([(1, "Dear")], "customer_no int, salutation string"))
    assert rows(flags, "customer_no", "possible_duplicate") == [(1, True), (2, False), (3, True)]
    base = people.select("address_no", F.col("customer_no").alias("group_customer_no"), *addresses.COLUMNS, "primary_ind", F.lit(D0).alias("create_dt"), F.lit("m").alias("created_by"), F.lit(D0 + timedelta(2)).alias("last_update_dt"), F.lit("m").alias("last_updated_by"))
    log = spark.createDataFrame([("1", D0 + timedelta(1), "u", "Updated", "city", "here", "there")], "alternate_key string, date timestamp_ntz, userid string, action string, column_updated string, old_value string, new_value string")
    h = addresses.history(log, base)
    assert rows(h.where("address_no = 1"), "event_subtype", "city") == [("Change", "there"), ("Creation", "here"), ("Current", "town")]
    scores = spark.createDataFrame([(1, D0, 5)], "group_customer_no int, score_dt timestamp_ntz, pro_score int")
    b = addresses.build(h.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), [], scores, {"pro_score": "address_pro_score_level"})
    assert b.where("address_pro_score_level = 5").count() == 3
    assert addresses.address_stream(catalog, b, ["address_no", "city"], 1).columns == ["address_no", "city"]


BANDS = ["Under 5 years", "5 to 9 years", "10 to 14 years", "15 to 17 years", "18 and 19 years", "20 to 24 years", "85 years and over"]


def test_census(spark):
    ages = ["Under 5 years", "5 to 9 years", "18 years", "19 years", "20 years", "21 years", "22 to 24 years", "85 years and over"]
    rows_ = [(2010, "sf1", f"P012{i:03}", f"Total!!{sex}!!{age}", "SEX BY AGE") for i, (sex, age) in enumerate((x, y) for x in ("Male", "Female") for y in ages)]
    rows_ += [(2010, "sf1", "P012100", "Total!!Male", "SEX BY AGE"), (2010, "sf1", "P012101", "Total!!Female", "SEX BY AGE"), (2010, "sf1", "P012900", "Total!!Male", "SEX BY AGE")]
    rows_ += [(2010, "sf1", "P003002", "Total!!Population of one race!!White alone", "RACE"), (2010, "sf1", "P003007", "Total!!Population of one race!!Some Other Race alone", "RACE"), (2010, "sf1", "P003001", "Total", "RACE")]
    rows_ += [(2010, "acs5/profile", "DP03_0062", "Estimate!!Median household income (dollars)", "ECONOMIC"), (2010, "acs5/profile", "DP03_0063", "Estimate!!Mean household income (dollars)", "ECONOMIC"), (2010, "acs5/profile", "DP05_0002", "Estimate!!SEX AND AGE!!Male", "DEMOGRAPHIC")]
    labels = spark.createDataFrame(rows_, "year int, dataset string, variable string, label string, concept string")
    known = census.variables(labels)
    assert {r["variable"] for r in known.collect()} == {r[2] for r in rows_} - {"P003001", "P012900"}

    def ask(year, dataset, state):
        if state == "99":
            raise OSError
        return [{"GEOID": f"g{state}", "variable": r[2], "value": None if "acs" in dataset else 1.0, "estimate": 50_000.0 if "acs" in dataset else None, "moe": 10.0 if "acs" in dataset else None} for r in rows_ if (r[0], r[1]) == (year, dataset)]

    data = census.data(census.download(spark, [(2010, "sf1"), (2010, "acs5/profile")], ["01", "99"], ask), known)
    assert data.where("dataset <> 'sf1' and type <> 'income'").count() == 0
    got = {r["feature"]: (r["value"], r["moe"]) for r in census.age_features(data, BANDS).collect()}
    assert got == {k: (v, 0.0) for k, v in {"Under 5 years": 2.0, "5 to 9 years": 2.0, "18 and 19 years": 4.0, "20 to 24 years": 6.0, "85 years and over": 2.0}.items()}
    assert {r["feature"]: r["moe"] for r in census.income_features(data).collect()} == {"Median Income": 10.0, "Mean Income": 10.0}
    wide = census.features(data, BANDS)
    assert wide.count() == 1 and {f"address_{x}_level" for x in ("white", "other", "male", "median_income", "mean_income")} <= set(wide.columns)
    out = census.address_census(spark.createDataFrame([("g01", D0), ("zz", D0)], "GEOID string, timestamp timestamp_ntz"), wide).collect()
    people = [c for c in wide.columns if re.search(census.PEOPLE, c)]
    assert sum(out[0][c] for c in people if out[0][c]) == pytest.approx(3) and {r["GEOID"] for r in out} == {"g01", "zz"}


def test_surveys(spark, tmp_path):
    sheet = pd.DataFrame([["When", "Mail", "Your number", "Like", None], [None, None, None, "Tea", "Milk"], *[[45000.0 + i, f"P{i}@q.com", str(i), "yes", None if i % 2 else "no"] for i in range(12)]])
    df = surveys.read_sheet(spark, sheet)
    assert rows(df.select("question", "subquestion").distinct(), "*") == [("Like", "Milk"), ("Like", "Tea"), ("Your number", None)]
    assert df.count() == 12 + 12 + 6 and df.where("timestamp is null or email is null").count() == 0
    emails = spark.createDataFrame([(i, i + 50, "Y", D0 - timedelta(900), f"p{i}@q.com") for i in range(6)], "customer_no int, group_customer_no int, primary_ind string, timestamp timestamp_ntz, address string")
    customers = spark.createDataFrame([(i, i + 50) for i in range(12)], "customer_no int, group_customer_no int")
    catalog = Catalog(spark, str(tmp_path))
    out = surveys.survey_stream([("/x/Tea.xlsx", df)], emails, customers, ("a", "b"), catalog)
    assert out.count() == 18 and out.where("length(customer_hash) <> 64 or length(group_customer_hash) <> 64 or survey <> 'Tea'").count() == 0
    assert surveys.survey_stream([("/x/Tea.xlsx", df)], emails, customers, ("a", "b"), catalog).count() == 18
    with pytest.raises(ValueError):
        surveys.survey_stream([("/x/Tea.xlsx", df.unionByName(df))], emails, customers, ("a", "b"))
    assert surveys.survey_cross(out, "^Like$", "nothing").columns[:3] == ["customer_hash", "group_customer_hash.1", "timestamp.1"]
    table = customers.withColumn("amount", F.lit(2.0))
    more = surveys.append_features(out, [customers, table], ("a", "b"), [F.sum("amount").alias("total")])
    assert more.columns[-1] == "total" and "group_customer_no" not in more.columns and more.where("total = 2").count() == 18
    with pytest.raises(ValueError, match="zz"):
        surveys.append_features(out, [table], ("a", "b"), [F.sum("amount"), F.max("zz")])
    with pytest.raises(ValueError):
        surveys.find_column(df, F.length, "least")
    with pytest.warns(UserWarning):
        assert surveys.find_column(df.select("question", "answer"), lambda c: F.lit(1), 3) == "question"


ROWS = [{"id": str(i), "name": f"n{i}", "x": {"y": i}} for i in range(250)]
FAILED = {"n": 0}


def fake(method, url, key, body=None):
    from urllib.parse import parse_qs, urlparse

    q = {k: int(v[0]) for k, v in parse_qs(urlparse(url).query).items()}
    if method != "GET":
        return (200, {"did": [method, url, body]})
    kind = urlparse(url).path.rsplit("/", 1)[-1]
    data = [{"id": "9", "tag": "old"}, {"id": "8", "tag": "Orphan Account"}] if kind == "tags" else ROWS
    at = q.get("offset", 0)
    return 200, {kind: data[at : at + q["limit"]], "meta": {"total": str(len(data))}}


def test_rest(spark):
    spark.dataSource.register(rest.PagedSource)
    read = lambda **o: spark.read.format("paged_rest").options(url="http://h/api/things", transport="tests.test_plans:fake", **o).schema("id string, name string, x string").load()
    assert rest.offsets(250, 30, 150) == [(30, 100), (130, 50)] and rest.offsets(0) == []
    import sys

    sys.modules.setdefault("tests.test_plans", sys.modules[__name__])
    reader = rest.PagedReader(spark.createDataFrame([], "id string, name string, x string").schema, {"url": "http://h/api/things", "transport": "tests.test_plans:fake"})
    pages = reader.partitions()
    assert len(pages) == 3 and sum(len(list(reader.read(p))) for p in pages) == 250
    assert next(iter(reader.read(pages[2]))) == ("200", "n200", '{"y": 200}')
    assert read().count() == 250 and read().where("id = '200'").first()["x"] == '{"y": 200}'


def test_client():
    c = rest.Client("http://h/api", "k", fake)
    assert c.rename_tags(["old"], ["new"])[0]["did"] == ["PUT", "http://h/api/tags/9", {"tag": {"tag": "new"}}]
    with pytest.warns(UserWarning):
        assert len(c.delete_tags(["old", "zz"])) == 1
    assert rest.Client("http://h", "k", fake, dry_run=True).execute("p", 1) == {"method": "POST", "url": "http://h/p", "body": 1}
    with pytest.raises(RuntimeError):
        c.execute("p", codes=(404,))
    done = rest.resolve_orphans(c, [{"id": 1, "address": "a@test", "to": "b"}, {"id": 2, "address": "b@x"}, {"id": 3, "address": "c@test"}], lambda r: {1: "update", 2: "tag", 3: "nothing"}[r["id"]], "test$")
    assert done[0]["did"][1] == "http://h/api/contacts/1" and done[1]["method"] == "POST" and len(done) == 2
    assert [marketing.resolve(*x) for x in ((True, True, True), (True, False, True), (True, True, False), (False, True, True))] == ["update", "tag", "nothing", "nothing"]


def test_resilient():
    calls = []

    def fail():
        calls.append(1)
        raise OSError

    assert resilient(fail, 3, 1, "d", sleep=lambda s: None) == "d" and len(calls) == 3
    assert resilient(lambda: 5) == 5


def test_tables(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    t.register("nation")
    assert t.table("nation", ["n_name"]).columns == ["n_name"] and t.sql("select count(*) n from nation").first()["n"] == 25


def test_follow(spark, streams, tmp_path):
    a, _ = streams
    catalog = Catalog(spark, str(tmp_path / "c"))
    for k, part in enumerate((a.where("feature_a < 40"), a.where("feature_a >= 40"))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = follow(spark, str(tmp_path / "in"), a.schema, catalog, "followed", query=f"q{tmp_path.name}")
        q.awaitTermination()
        assert catalog.read("followed").count() == (40, 90)[k]
    counts = late_counts(spark.readStream.schema(a.schema).parquet(str(tmp_path / "in")), "group_customer_no")
    assert counts.isStreaming


def test_follow_late(spark, streams, tmp_path):
    """A late batch adds its rows and takes none away; a batch that runs again adds nothing."""
    a, _ = streams
    catalog = Catalog(spark, str(tmp_path / "c"))
    parts = a.where("feature_a >= 40"), a.where("feature_a < 20"), a.where("feature_a between 20 and 39")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        follow(spark, str(tmp_path / "in"), a.schema, catalog, "late", query=f"l{tmp_path.name}").awaitTermination()
    assert rows(catalog.read("late"), "*") == rows(a, "*")
    catalog.append("late", a, tag=f"l{tmp_path.name}-0")
    assert catalog.read("late").count() == 90


def test_matching_orphans(spark):
    contacts = spark.createDataFrame([("1", " Old@a.com"), ("2", "used@b.com"), ("3", "x@c.com")], "id string, email string")
    fields = spark.createDataFrame([("1", "1", "7"), ("3", "1", "9"), ("1", "2", "8")], "contact string, field string, value string")
    changes = spark.createDataFrame([("old@a.com", "new@a.com", 7), ("old@a.com", "used@b.com", 7), ("old@a.com", "new@a.com", 8), ("gone@z.com", "new@a.com", 7), ("x@c.com", None, 9), ("used@b.com", "n@n.com", 1)], "from string, to string, customer_no int")
    got = {(r["from"], r["to"], r["customer_no"]): r["action"] for r in marketing.resolutions(changes, contacts, fields).collect()}
    assert got == {("old@a.com", "new@a.com", 7): "update", ("old@a.com", "used@b.com", 7): "tag", ("old@a.com", "new@a.com", 8): "nothing", ("gone@z.com", "new@a.com", 7): "nothing", ("x@c.com", None, 9): "tag", ("used@b.com", "n@n.com", 1): "nothing"}


def test_email_times(spark):
    """The first response counts for a promotion less than 30 days off, on either side; a source without promotion stays."""
    t = lambda n: D0 + timedelta(days=n)
    promos = spark.createDataFrame([(3, 1, t(10), 5, 6, 1, None), (3, 1, t(38), 5, 6, 1, "a@b"), (3, 1, t(39), 5, 6, 1, None)], "media_type int, customer_no int, promote_dt timestamp_ntz, appeal_no int, campaign_no int, source_no int, eaddress string")
    replies = spark.createDataFrame([(1, t(9), 1), (2, t(9), 2)], "customer_no int, response_dt timestamp_ntz, source_no int")
    out = email.timed(email.data(promos, replies, t(0), t(20)))
    assert {(r["source_no"], r["promote_dt"], r["timestamp"], r["eaddress"]) for r in out.collect()} == {(1, t(10), t(9), None), (1, t(38), t(9), "a@b"), (1, t(39), t(39), None), (1, None, t(9), "a@b"), (2, None, t(9), None)}


def test_normalised_rows(spark):
    """A row's parts come from one place."""
    parsed = ", ".join(f"`parsed.{c}` string" for c in addresses.PARSED)
    none = dict.fromkeys([*addresses.COLUMNS, "matched_address", "formatted_address", "location_type", *(f"parsed.{c}" for c in addresses.PARSED)])
    cases = [
        ({"formatted_address": "12 Main St, Boston, MA 02139, USA", "location_type": "ROOFTOP", "city": "elsewhere"}, ("12 Main St", None, "Boston", "MA", "02139", "USA")),
        ({"formatted_address": "Main St, Boston, MA, USA", "location_type": "ROOFTOP", "street1": "web added", "city": "here"}, (None, None, "Here", None, None, None)),
        ({"matched_address": "1 A ST, TOWN, NY, 10001", "parsed.unit": "apt 4", "parsed.city": "no"}, ("1 A St", "Apt 4", "Town", "NY", "10001", "USA")),
        ({"parsed.road": "b rd", "parsed.house_number": "5", "parsed.po_box": "po box 9", "parsed.unit": "2f", "city": "lost"}, ("5 B Rd, 2f", "Po Box 9", None, None, None, None)),
        ({"street1": "12 None Such Rd", "street2": "x", "parsed.house": "unit unit"}, ("12 None Such Rd", "X", None, None, None, None)),
    ]
    df = spark.createDataFrame([(i, *(none | c).values()) for i, (c, _) in enumerate(cases)], f"i int, {', '.join(f'{c} string' for c in (*addresses.COLUMNS, 'matched_address', 'formatted_address', 'location_type'))}, {parsed}")
    got = addresses.normalised(df).orderBy("i").select(*(f"{c}_cleaned" for c in ("street1", "street2", "city", "state", "postal_code", "country"))).collect()
    assert [tuple(r) for r in got] == [w for _, w in cases]


def test_unit_grammar(spark):
    df = spark.createDataFrame([
        (1, None, "02139", '{"road": "front st", "postcode": "02139"}'),
        (2, "apt 5", "02139", '{"road": "main st", "postcode": "02139"}'),
        (3, "suite", "02139", '{"road": "main st nw # 7", "postcode": "02139"}'),
        (4, None, "02139", '{"road": "main st", "postcode": "apt 3", "suburb": "a", "city": "b"}'),
        (5, None, "02139", '{"road": "5 main ave 2f", "level": "2f", "house": "2f", "postcode": "02139"}'),
    ], "n int, street2 string, postal_code string, components string")
    out = addresses.repaired(df).orderBy("n").select("`parsed.unit`", "`parsed.road`", "`parsed.postcode`", "`parsed.city`", "`parsed.house`").collect()
    assert [tuple(r) for r in out] == [(None, "front st", "02139", None, None), ("apt 5", "main st", "02139", None, None), ("7", "main st nw", "02139", None, None), ("apt 3", "main st", None, "a, b", None), ("2f", "5 main ave", "02139", None, None)]


def test_survey_files(spark, tmp_path):
    import zipfile

    cells = lambda n, values: "".join(f'<c r="{chr(65 + i)}{n}" t="inlineStr"><is><t>{v}</t></is></c>' for i, v in enumerate(values) if v is not None)
    sheet = [["When", "Mail", "Like", None], [None, None, "Tea", "Milk"], ["45000.5", "p1@q.com", "yes", "no"]]
    xml = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>' + "".join(f'<row r="{i}">{cells(i, r)}</row>' for i, r in enumerate(sheet, 1)) + "</sheetData></worksheet>"
    (tmp_path / "deep").mkdir()
    with zipfile.ZipFile(tmp_path / "deep" / "One.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", xml)
    (tmp_path / "Two.csv").write_text("When,Mail,Like,\n,,Tea,Milk\n45001,p2@q.com,maybe,\n")
    (tmp_path / "no.txt").write_text("x")
    found = surveys.read_files(spark, str(tmp_path)).withColumn("filename", F.substring_index("filename", "/", -1))
    assert rows(found, "filename", "email", "question", "subquestion", "answer") == [("One.xlsx", "p1@q.com", "Like", "Milk", "no"), ("One.xlsx", "p1@q.com", "Like", "Tea", "yes"), ("Two.csv", "p2@q.com", "Like", "Tea", "maybe")]
    assert rows(found.select("timestamp").distinct(), "timestamp") == [(datetime(2023, 3, 15, 12),), (datetime(2023, 3, 16),)]


def test_answers_as_one_sheet_at_a_time(spark):
    """Sheets without addresses or times, with two of them, with blank lines and markup."""
    lines = {
        "a": [["Q", "Mail", None], ["s", None, "t"], ["1", "p@q.com", "r@q.com"], [None, "p2@q.com", None], ["x xml:space=\"preserve\">y", None, "z"]],
        "b": [["Only", "Numbers"], [None, None], ["41000", "1"], ["2", "3"]],
        "c": [["Head"], [None]],
        "d": [["T", "U", "V"], [None, None, None], ["45000", "45001", "a@b.co"], ["45002", "5", "c@d.co"]],
    }
    cell_rows = [(name, i, j, v) for name, sheet in lines.items() for i, row in enumerate(sheet) for j, v in enumerate(row) if v is not None]
    got = surveys.answers(spark.createDataFrame(cell_rows, "filename string, row long, col int, value string"))
    for name, sheet in lines.items():
        one = surveys.read_sheet(spark, pd.DataFrame(sheet, dtype="object"))
        names = ("email", "timestamp", "question", "subquestion", "answer")
        assert rows(got.where(F.col("filename") == name), *names) == rows(one, *names), name


def test_workbooks_are_read_as_written():
    table = [["a & b", 1, None, "<x>", 2.5], [], [None, " lead", "ünï"], [*[None] * 30, "far"]]
    got = list(xlsx_cells(xlsx(table)))
    assert got == [(i, j, str(v)) for i, r in enumerate(table) for j, v in enumerate(r) if v is not None]


def test_households(spark):
    people = spark.createDataFrame([(1, 10, "Individual", "Active", "A", "B"), (2, 10, "Organization", "Active", "A", "B"), (3, 10, "Individual", "Inactive", "A", "B"), (4, 11, "Individual", "Active", "", "B"), (5, 12, "Individual", "Active", " Al ", "Be")], "customer_no int, group_customer_no int, cust_type_desc string, inactive_desc string, fname string, lname string")
    places = spark.createDataFrame([(10, "1", "x st", None, "c", "s"), (10, "2", "y st", "", "c", "s")], "group_customer_no int, house_number string, road string, unit string, city string, state string")
    phones = spark.createDataFrame([(10, "555"), (10, None)], "group_customer_no int, phone string")
    mails = spark.createDataFrame([(10, "M@x.org", 1), (10, "assistant@x.org", 6), (12, "q@x.org", None)], "group_customer_no int, address string, eaddress_type int")
    out = duplicates.load(people, places, phones, mails)
    assert rows(out, "customer_no", "fname", "road", "unit", "phone", "email") == [(1, "a", "x st", None, "555", "m@x.org"), (1, "a", "y st", None, "555", "m@x.org"), (5, "al", None, None, None, "q@x.org")]


def test_edges_are_outside(spark):
    """The points of a polygon's edges and corners aren't in it."""
    ring = [(0.0, -1.0), (0.0, 9000.0), (9001.0, -1.0)]
    points = [(0.0, 0.0, False), (0.0, 9000.0, False), (100.0, 8900.0, False), (5.0, -1.0, False), (0.01, 0.0, True), (100.0, 8899.99, True), (-0.01, 0.0, False), (None, 0.0, None)]
    df = spark.createDataFrame(points, "lat double, lon double, want boolean")
    assert [r.got for r in df.select(addresses.inside(F.col("lat"), F.col("lon"), ring).alias("got")).collect()] == [p[2] for p in points]


def test_survey_cross_takes_every_answer(spark):
    from rivulet.queries import QUERIES, SQL

    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/conversations.parquet").where("role = 'assistant'")
    got = QUERIES["survey_cross"](spark, d)
    assert got.select("customer_hash", "`subquestion.2`").where("`subquestion.2` is not null").distinct().count() == rows.select("conv_id", "turn").distinct().count()
    assert "% 2" not in SQL["survey_cross"]
    told = spark.createDataFrame([(1, "assistant", "a"), (2, "ASSISTANT", "b")], "customer_hash int, question string, answer string")
    assert [r.customer_hash for r in surveys.survey_cross(told, "assist", "nothing").collect()] == [1]
