"""Tables of a row per request are joined by shuffles, however small their files look."""

from pyspark.sql import functions as F

from civicspark.testbed import adapter, queries


def broadcasts(df, *keys):
    plan = df._jdf.queryExecution().toString()
    return [line for line in plan.splitlines() if "BroadcastHashJoin" in line and any(f"[{k}#" in line for k in keys)]


def test_requests_do_not_broadcast_the_order_lines(spark, tmp_path, monkeypatch):
    tables = {
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date, o_orderpriority string, o_totalprice double",
        "lineitem": "l_orderkey long, l_shipdate date",
        "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
        "nation": "n_nationkey int, n_name string",
    }
    for name, shape in tables.items():
        spark.createDataFrame([], shape).write.parquet(f"{tmp_path}/{name}.parquet")
    seen = []
    monkeypatch.setattr(adapter, "materialize", lambda df, name: seen.append(df) or df)
    adapter.requests(spark, str(tmp_path))
    assert not broadcasts(seen[0], "o_orderkey", "o_custkey")


def test_feature_rows_get_their_times_without_a_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([("1", "2024-01-01")], "service_request_id string, t string")
    rows = rows.selectExpr("service_request_id", "CAST(t AS timestamp) AS requested_date")
    monkeypatch.setattr(adapter, "requests", lambda *_: rows)
    monkeypatch.setattr(queries, "featured", lambda *_: rows.select("service_request_id"))
    out = queries.filed(spark, "")
    assert out.count() == 1 and not broadcasts(out, "service_request_id")


def test_a_larger_feed_has_more_ranges_not_larger_ones(spark, tmp_path, monkeypatch):
    rows = [(k * 7919 % 1000 // 3, k, float(k)) for k in range(1000)]
    spark.createDataFrame(rows, queries.LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, pull = [], queries.paging.pull
    monkeypatch.setattr(queries, "RANGE_ROWS", 20)
    monkeypatch.setattr(queries.paging, "pull", lambda spark, feed, *a, **kw: seen.append((feed, kw)) or pull(spark, feed, *a, **kw))
    out = queries.paged_pull(spark, str(tmp_path))
    assert sorted(map(tuple, out.collect())) == sorted(rows)
    feed, how = seen[0]
    assert how["rows_per_range"] == 20
    files = spark.read.parquet(feed.path).groupBy(F.input_file_name()).agg(F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high")).orderBy("low").collect()
    assert len(files) > 20 and all(a["high"] < b["low"] for a, b in zip(files, files[1:]))


def test_shuffles_of_large_tables_are_cut_small(spark):
    queries.adapter.prepare(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
