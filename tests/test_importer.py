"""The import on small fixtures."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from foyer import operators as op
from foyer import schemas
from foyer.plans import import_job
from foyer.plans import importer as I
from foyer.schemas import SCHEMAS
from foyer.sources import TooManyErrors, load_staging

from conftest import has_types, rows


def staging(spark, *people):
    base = {f.name: None for f in SCHEMAS["staging"].fields}
    return spark.createDataFrame([tuple({**base, **p}.values()) for p in people], SCHEMAS["staging"])


def test_cleaning_empties_the_checks(spark):
    dirty = staging(
        spark,
        {"legacy_no": 1, "prefix": "mr", "lname": "o'BRIEN", "state": "LONDON", "order_dt": "1/02/2014", "perf_dt": "1/02/2014 19:30:00"},
        {"legacy_no": 2, "prefix": "Prof", "lname": "smith", "state": "NSW", "order_dt": "11/02/2014", "perf_dt": "11/02/2014 19:30:00"},
    )
    clean = I.clean_staging(dirty)
    got = clean.select("prefix", "lname", "state", "order_dt", "perf_dt", "city")
    assert rows(got) == [
        ("Mr.", "O'Brien", None, "01/02/2014", "01/02/2014 19:30:00", ""),
        ("Prof", "Smith", "NSW", "11/02/2014", "11/02/2014 19:30:00", ""),
    ]
    before = {r["rule"]: r["n_rows"] for r in I.staging_checks(dirty).collect()}
    after = {r["rule"]: r["n_rows"] for r in I.staging_checks(clean).collect()}
    assert before["order_dt_length"] == before["perf_dt_length"] == 1
    assert not any(after.values())


def opted(spark, *answers):
    data = [(n, a, b) for n, pair in enumerate(answers) for a, b in [pair]]
    return spark.createDataFrame(
        data, "customer_no long, presenter_email_DNM string, email_address_decline string"
    )


@pytest.mark.parametrize(
    ("strict", "expected"),
    [
        (False, [(0, 2, 4), (1, 4, 4), (2, 4, 9), (3, 7, 9)]),
        (True, [(0, 2, 4), (1, 2, 4), (2, 4, 9), (3, 7, 9)]),
    ],
)
def test_preferences(spark, strict, expected):
    customers = spark.createDataFrame([(n, 7, 9) for n in range(4)], "customer_no long, emarket_ind int, mail_ind int")
    staged = opted(spark, ("Yes", "Do Not Email"), ("yes", None), (None, None))
    assert rows(I.preferences(customers, staged, strict)) == expected


def test_interests(spark):
    customers = spark.createDataFrame([(n,) for n in range(4)], "customer_no long")
    staged = opted(spark, ("Yes", "Do Not Email"), ("Yes", None), (None, None))
    assert rows(I.interests(customers, staged)) == [(n, c, "Y") for n in (1, 2) for c in (14, 9)]


def people(spark):
    staged = spark.createDataFrame(
        [
            (n + 100, n, "Mr.", "A", "B", "orig st", "x", "orig", "S", "1", "C", "1", "2", "o@x")
            for n in (1, 2, 3, 3)
        ],
        "customer_no long, legacy_no long, " + ", ".join(f"{c} string" for c in I.PERSON[2:]),
    )
    quality = spark.createDataFrame(
        [(n, "q st", None, "q", "S", "9", "C", None, "8", None) for n in (1, 2)],
        "legacy_no long, street1 string, street2 string, city string, state string, pcode string, "
        "country string, phone1 string, phone2 string, email string",
    )
    mail = spark.createDataFrame(
        [(1, "q@x", "unreachable"), (2, "q@x", None)], "legacy_no long, email string, result string"
    )
    return staged, quality, mail, spark.createDataFrame([(102,)], "customer_no long")


def test_customer_load(spark):
    columns = ("customer_no", "street1", "street2", "eaddress", "original_source_no", "ref_id")
    first = I.primary_customer_load(*people(spark))
    assert has_types(first, SCHEMAS["primary_customer"])
    assert rows(first.select(*columns)) == [
        (101, "q st", None, None, 4, 1),
        (103, "orig st", "x", "o@x", 4, 3),
    ]
    again = I.primary_customer_load(*people(spark), reload_with_original=True)
    assert rows(again.select(*columns))[1] == (102, "orig st", "x", "q@x", 4, 2)


def test_preview_fills_field_by_field(spark):
    staged, quality, mail, _ = people(spark)
    got = I.enrich_preview(staged, quality, mail).where("customer_no = 101").first()
    assert (got["street1"], got["street2"], got["phone1"], got["phone2"], got["email"]) == ("q st", "x", "1", "8", "o@x")


def test_phone_reclass(spark):
    at = dt.datetime(2014, 10, 21, 22)
    midnight = dt.datetime(2014, 10, 22)
    schema = "customer_no long, phone string, type int, address_no int, created_by string, create_dt timestamp_ntz"
    phones = [
        (1, "0411", 1, 5, "dbo", at), (1, "0211", 1, 5, "dbo", at), (1, "0412", 3, 5, "dbo", at),
        (2, "0413", 1, 5, "dbo", at), (1, "0414", 2, 5, "DBO ", midnight),
        (1, "0415", 2, 5, "dbo", midnight + dt.timedelta(seconds=1)),
    ]
    address = spark.createDataFrame([(1, 227), (1, 227), (2, 1)], "customer_no long, country int")
    out = I.phone_reclass(spark.createDataFrame(phones, schema), address, dt.datetime(2014, 10, 21, 21), midnight)
    moved = out.where("type = 5 and address_no is null").select("phone")
    assert rows(moved) == [("0411",), ("0414",)] and out.count() == len(phones)


def test_price_types_and_zones(spark):
    staged = staging(
        spark,
        {"legacy_no": 1, "price_type": "Adult " + "x" * 40, "zone": "premium"},
        {"legacy_no": 2, "price_type": "Child", "zone": "Nowhere"},
    )
    matchup = spark.createDataFrame([(("Adult " + "x" * 40)[:30].upper(), 4)], "matchup_text string, price_type int")
    zones = spark.createDataFrame([(8, "Premium"), (2, "Premium")], "zone_no int, description string")
    mapped, unmapped = I.map_price_zone(staged, matchup, zones)
    assert rows(mapped.select("legacy_no", "price_type_no", "zone_no")) == [(1, 4, 2), (2, None, None)]
    assert rows(unmapped.select("legacy_no")) == [(2,)]


def test_whole_import(small):
    b = small
    out = I.run_import(
        b.tables("staging", "quality_address", "quality_email", "loaded", "customer", "matchup", "zone")
    )
    n_rows = b["staging"].count()
    buyers = b["staging"].select("legacy_no").distinct().count()
    assert has_types(out["ticket_history"], SCHEMAS["ticket_history"])
    assert out["ticket_history"].count() == n_rows
    assert out["cust_keyword"].count() == out["const_cust"].count() == buyers
    assert out["next_id"].first()[0] == 100_000 + buyers + 10
    assert out["customer"].count() == b["customer"].count()
    assert out["unmapped"].where(F.col("price_type_no").isNotNull()).count() == 0
    numbers = [r[0] for r in rows(out["const_cust"].select("customer_no"))]
    assert sorted(numbers) == list(range(100_001, 100_001 + buyers))


class BrokenOff(Exception):
    """What stops a run in the middle."""


def test_import_job_goes_on_where_it_broke_off(small, spark, tmp_path, monkeypatch):
    tables = {n: small[n] for n in import_job.SOURCES}
    job = import_job.ImportJob(spark, str(tmp_path / "job"), tables)
    assert job.manifest().count() == 0
    history = I.ticket_history

    def stop(rows):
        raise BrokenOff

    monkeypatch.setattr(I, "ticket_history", stop)
    with pytest.raises(BrokenOff):
        job.run()
    done = {r.target for r in job.manifest().collect()}
    assert done == set(import_job.TARGETS[: import_job.TARGETS.index("ticket_history")])
    files = lambda: {p: p.stat().st_mtime_ns for t in done for p in (tmp_path / "job" / t).rglob("part-*")}
    before = files()
    monkeypatch.setattr(I, "ticket_history", history)
    found = job.run()
    assert files() == before and set(found) == set(import_job.TARGETS)
    plain = I.run_import(tables)
    for name in ("primary_customer", "cust_keyword", "ticket_history", "const_cust", "next_id", "checks", "unmapped"):
        assert rows(found[name]) == rows(plain[name].select(*found[name].columns)), name
    counts = {r.target: r.n_rows for r in job.manifest().collect()}
    assert counts == {name: df.count() for name, df in found.items()}
    other = import_job.ImportJob(spark, str(tmp_path / "job"), tables | {"staging": tables["staging"].limit(5)})
    with pytest.raises(ValueError, match="other staging rows"):
        other.run()


def test_load_with_rejects(spark, tmp_path):
    lines = ["a\tb\tn", "1\tx\t5", "2\ty\tmany", "3\tlong name \t", "4\tz", "5\t\t7", "6\tq\t8\textra"]
    (tmp_path / "file.tsv").write_text("\n".join(lines) + "\n")
    schema = schemas.table(a=schemas.LONG, b=schemas.TEXT, n=schemas.INT)
    wanted = {"limits": {"b": 4}, "required": {"n_missing": F.col("n").isNull()}}
    found = load_staging(spark, str(tmp_path / "file.tsv"), schema, **wanted, max_errors=3)
    assert rows(found.rows) == [(1, "x", 5), (3, "long name ", None), (5, None, 7)]
    assert rows(found.rejects) == [("2\ty\tmany",), ("4\tz",), ("6\tq\t8\textra",)]
    assert {r.rule: r.n_rows for r in found.counts.collect()} == {"rows": 3, "rejects": 3, "b": 1, "n_missing": 1}
    with pytest.raises(TooManyErrors, match="3 lines"):
        load_staging(spark, str(tmp_path / "file.tsv"), schema, **wanted, max_errors=2)


def test_profiles_of_many_columns_take_one_shuffle(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x "), (None, 1, "X")], "p string, q int, r string")
    found = op.profile_many(df, ["p", "q", "r"])
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = [(c, None if r[0] is None else str(r[0]), r[1]) for c in "pqr" for r in op.profile_distinct(df, c).collect()]
    assert rows(found) == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
    refs = spark.createDataFrame([("A", "x")], "name string, id string")
    faults = op.invalid_values(df, {"p": (refs, "name"), "r": (refs, "id"), "q": (refs, "id")})
    assert rows(faults) == [("q", "1", 2), ("q", "2", 1)]


def test_bitmaps_of_two_days_equal_a_recount(spark):
    old = spark.createDataFrame([(1, 5), (1, 5), (1, 70_000), (2, None), (3, -1), (3, 0)], "k int, n long")
    new = spark.createDataFrame([(1, 5), (1, 32_768), (2, 9), (4, 32_767)], "k int, n long")
    merged = op.merged_bitmaps(op.distinct_bitmaps(old, ["k"], "n"), op.distinct_bitmaps(new, ["k"], "n"))
    assert rows(op.counted_bitmaps(merged, ["k"], "c")) == [(1, 3), (2, 1), (3, 1), (4, 1)]
