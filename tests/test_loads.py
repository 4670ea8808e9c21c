"""Bucketed merges and the loads built on them."""

import os
import random
import re

from pyspark.sql import functions as F

from parcela.plans import loads
from parcela.sources import html, payloads
from parcela.sources.buckets import BUCKET, BucketTable

SCHEMA = "id string, part int, price bigint, note string"


def files(path):
    return {(d.rsplit("=", 1)[-1], f): os.path.getmtime(f"{d}/{f}") for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA + ", seq int")


def test_merge_is_a_keyed_update(spark, tmp_path):
    """Against a dictionary, over several batches with repeated keys, known keys and rows without a key."""
    rng, table, want = random.Random(3), BucketTable(spark, f"{tmp_path}/t", SCHEMA, ["id", "part"], 8), {}
    assert table.read().collect() == []
    for batch in range(4):
        data = [(rng.choice([None, *"abcdefghijklmnopqrstuvwxyz"]), rng.choice([None, 1, 2]), rng.choice([None, i, -i]), f"{batch}-{i}", i) for i in range(rng.choice([0, 3, 40]))]
        last = {(r[0], r[1]): r for r in data if r[0] is not None and r[1] is not None}
        got = table.merge(rows(spark, data), update=["price"], order_by=["seq"], failed=F.col("price").isNull())
        assert got == {"staged": len(last), "inserted": len(last.keys() - want.keys()), "updated": len(last.keys() & want.keys()),
                       "failed": sum(r[2] is None for r in last.values()), "skipped": sum(r[0] is None or r[1] is None for r in data)}
        for k, r in last.items():
            want[k] = (r[2], want[k][1] if k in want else r[3])
        assert {(r.id, r.part): (r.price, r.note) for r in table.read().collect()} == want


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    table = BucketTable(spark, f"{tmp_path}/t", SCHEMA, ["id"], 16)
    table.merge(rows(spark, [(f"k{i}", 1, i, "first", i) for i in range(400)]))
    before = files(table.path)
    one = spark.createDataFrame([("k7", 1, 99, "second")], SCHEMA)
    number = one.select(table.bucket().alias("b")).first()["b"]
    assert table.merge(one) == {"staged": 1, "inserted": 0, "updated": 1, "failed": 0, "skipped": 0}
    after = files(table.path)
    assert {k: v for k, v in before.items() if k[0] != str(number)} == {k: v for k, v in after.items() if k[0] != str(number)}
    assert {k for k in before if k[0] == str(number)}.isdisjoint(after)
    assert {r.id: r.price for r in table.read().where("id IN ('k7', 'k8')").collect()} == {"k7": 99, "k8": 8}
    plan = table._read(table.path).where(F.col(BUCKET).isin([number]))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({BUCKET}" in plan


def test_replay_and_update_only(spark, tmp_path):
    table = BucketTable(spark, f"{tmp_path}/t", SCHEMA, ["id"], 4)
    data = rows(spark, [(f"k{i}", 1, i, "x", i) for i in range(50)])
    table.merge(data)
    again = table.merge(data)                                # a batch that is loaded twice changes nothing
    assert (again["inserted"], again["updated"]) == (0, 50) and table.read().count() == 50
    done = table.merge(rows(spark, [("k1", 1, -1, "y", 0), ("new", 1, 5, "y", 0)]), update={"price": F.coalesce("s.price", "t.price"), "note": F.concat("t.note", "s.note")}, insert=False)
    assert (done["inserted"], done["updated"]) == (0, 1)
    got = {r.id: (r.price, r.note) for r in table.read().collect()}
    assert len(got) == 50 and got["k1"] == (-1, "xy") and "new" not in got


def page(*items, wrap='{"results":[%s]}'):
    return wrap % ",".join(items)


def test_listing_pages_are_kept_once(spark, tmp_path):
    table, pages = BucketTable(spark, f"{tmp_path}/l", loads.LISTINGS_US, ["listing_id"], 4), BucketTable(spark, f"{tmp_path}/p", loads.PAGES_US, ["page_id"], 4)
    landed = [(0, page('{"zpid":"1","price":"100","livingArea":"50","city":"A"}', '{"zpid":"2","price":"x"}', '{"price":"7"}', '{"zpid":"1","price":"120","livingArea":"50"}')),
              (1, "not json"), (2, None), (3, page('{"zpid":"1","price":"130"}'))]
    df = spark.createDataFrame(landed, "n int, body string")
    got = loads.load_listings_us(table, pages, df, "body", "zillow", "2024-01-01 00:00:00", order_by=["n"])
    assert got == {"staged": 2, "inserted": 2, "updated": 0, "failed": 1, "skipped": 0}
    assert {r.listing_id: r.price_usd for r in table.read().collect()} == {"1": 130, "2": None}       # the last item of the last page
    assert pages.read().count() == 3 and table.read().join(pages.read(), "page_id").count() == 2
    more = loads.load_listings_us(table, pages, df.where("n = 0"), "body", "zillow", "2024-02-01 00:00:00", order_by=["n"])
    assert (more["inserted"], more["updated"]) == (0, 2) and pages.read().count() == 3
    assert {r.listing_id: r.price_usd for r in table.read().collect()} == {"1": 120, "2": None}
    status = loads.summary_rows(spark, [("a", got), ("b", {**got, "failed": 2}), ("c", {k: 0 for k in got})]).collect()
    assert [(r.source, r.inserted, r.status) for r in status] == [("a", 2, "ok"), ("b", 2, "failed"), ("c", 0, "failed")]


def test_a_batch_is_read_once_and_a_new_table_needs_no_join(spark, tmp_path):
    """Landed pages are evaluated once for the pages and their listings; equal pages count by the last of them."""
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    body = page('{"zpid":"1","price":"100"}'), page('{"zpid":"1","price":"200"}')
    df = spark.createDataFrame([(0, body[0]), (1, body[1]), (2, body[0]), (3, None)], "n int, body string").mapInArrow(count, "n int, body string")
    table, pages = BucketTable(spark, f"{tmp_path}/l", loads.LISTINGS_US, ["listing_id"], 4), BucketTable(spark, f"{tmp_path}/p", loads.PAGES_US, ["page_id"], 4)
    got = loads.load_listings_us(table, pages, df, "body", "zillow", "2024-01-01 00:00:00", order_by=["n"])
    assert reads.value == 4 and got == {"staged": 1, "inserted": 1, "updated": 0, "failed": 0, "skipped": 0}
    assert [r.price_usd for r in table.read().collect()] == [100] and pages.read().count() == 2


def test_the_parser_of_pages_can_be_compiled(spark):
    """The JVM interprets methods over 8,000 bytes of code, which made the parser several times slower."""
    df = payloads.parse_listing_pages(spark.range(3).selectExpr("cast(id as string) AS p"), "p", keep=["p"], position="place")
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_the_parser_of_cards_can_be_compiled(spark):
    df = html.extract_cards(spark.range(3).selectExpr("cast(id as string) AS p"), "p", base_url="https://b.co", raw="raw_html")
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_a_page_with_an_object_under_data_is_parsed_once(spark):
    """One parse for a list, a page, an array under data and an object there; it had been one for each key of that object."""
    item = '{"zpid":" 7 ","listPrice":"5","beds":"2","listingDate":"2024-05-06","homeType":"condo"}'
    pages = [f'{{"data":{{"listings":[{item}]}}}}', f'{{"data":[{{"price":"1"}},{item}]}}', f"[{item}]", '{"data":{"props":null}}', '{"data":[{"id":"1","listingType":"rental"}]}', None]
    df = payloads.parse_listing_pages(spark.createDataFrame(list(enumerate(pages)), "n int, p string"), "p", keep=["n"], position="place")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") <= 4
    got = sorted((r.n, r.place, r.listing_id, r.price_usd, r.bedrooms, str(r.listing_date), r.property_type) for r in df.collect())
    assert got == [(n, p, "7", 5, 2, "2024-05-06", "condo") for n, p in ((0, 0), (1, 1), (2, 0))]


def test_counts_of_several_years_are_read_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    data = [("A", "x", '{"offenses":{"actuals":{"all":{"1994":2,"1995":3}}}}'), ("A", "y", '[{"count":"4"},{"value":"z"}]'), ("B", "x", '{"offenses":{}}'), ("B", "y", None), (None, "x", "[]")]
    counts = spark.createDataFrame(data, "ori string, offense string, payload string").mapInArrow(count, "ori string, offense string, payload string")
    agencies = spark.createDataFrame([("A", "c", "S", 1.0, 2.0), ("B", "c", "S", 1.0, 2.0)], "ori string, city string, state string, lat double, lon double")
    got = sorted(r.incident_id for r in loads.agency_rows(agencies, counts, [1994, 1995, 1996], "2024-01-01 00:00:00").collect())
    assert got == ["fbi_A_1994_x", "fbi_A_1994_y", "fbi_A_1995_x", "fbi_A_1995_y", "fbi_A_1996_y"] and reads.value == len(data)
    one = payloads.sum_year_counts(counts, "payload", "1995", keep=["ori", "offense"])
    assert one.columns == ["ori", "offense", "total"] and {(r.ori, r.offense): r.total for r in one.collect()} == {
        ("A", "x"): 3.0, ("A", "y"): 4.0, ("B", "x"): None, ("B", "y"): None, (None, "x"): 0.0}


def test_cards_keep_their_html_until_refreshed(spark, tmp_path):
    table = BucketTable(spark, f"{tmp_path}/c", loads.LISTINGS_CO, ["listing_id", "source"], 4)
    card = '<article data-id="%s"><a href="/inmueble/x-%s">see</a><h2>Casa %s</h2><p>$ %s</p>%s</article>'
    first = [(card % (1, 1, 1, "10.000.000", "<li>50 m2</li>") + card % (2, 2, 2, "20.000.000", ""),)]
    second = [(card % (1, 1, 1, "11.000.000", "<li>50 m2</li>") + card % (2, 2, 2, "21.000.000", "") + "<article>ad</article>",)]
    run = lambda data, at: loads.load_listings_co(table, spark.createDataFrame(data, "html string"), "html", "s", "Bogota", "Cundinamarca", at)
    assert run(first, "2024-01-01 00:00:00") == {"staged": 2, "inserted": 2, "updated": 0, "failed": 1, "skipped": 0}
    assert all(r.raw_html for r in table.read().collect())
    assert run(second, "2024-02-01 00:00:00") == {"staged": 2, "inserted": 0, "updated": 2, "failed": 1, "skipped": 0}
    assert {r.listing_id: (r.price_cop, r.raw_html is None) for r in table.read().collect()} == {"1": (11_000_000, True), "2": (21_000_000, False)}
