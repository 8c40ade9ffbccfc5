"""Scale properties visible in the physical plans."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + \
        df._jdf.queryExecution().optimizedPlan().toString()


def test_row_ranks_are_windows_inside_ranges(spark):
    for key in ("hr_tenure_rank", "sal_rank", "sal_rank_by_job", "emp_top3_salary"):
        text = plan(entry.queries()[key](spark, SF))
        ranks = [line for line in text.splitlines() if "rank(" in line.lower()]
        assert ranks and all("windowspecdefinition(_slot#" in line for line in ranks), key


def test_scans_read_only_needed_columns(spark):
    from tablewright.plans import hr
    df = hr.raw_table(spark, SF).select("id")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in text
    assert "c_acctbal" not in text


def test_partition_pruning(spark):
    text = plan(entry.queries()["orders_year_pruned"](spark, SF))
    assert "PartitionFilters: [isnotnull(OrderYear" in text and "= 1999" in text


def test_statistics_hold_no_column_in_one_buffer(spark):
    for key in ("population_clean", "movies_clean", "txn_describe"):
        text = plan(entry.queries()[key](spark, SF)).lower()
        assert "percentile(" not in text and "median(" not in text, key


def test_ledger_is_sorted_streaming_pass(spark):
    text = plan(entry.queries()["ledger_outcomes"](spark, SF))
    assert "MapInArrow" in text and "collect_list" not in text


def test_orders_and_details_join_without_shuffle_in_both_modes(spark):
    from pyspark.sql import functions as F
    from tablewright.plans import cache, retail
    saved = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                  "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in saved:
            spark.conf.set(k, "-1")
        for mode in ("cache", "table"):
            spark.conf.set(cache.MODE_CONF, mode)
            m = retail.model(spark, SF)
            j = m.orders.alias("O").join(m.order_details.alias("OD"),
                                         F.col("O.OrderID") == F.col("OD.OrderID"))
            j.write.format("noop").mode("overwrite").save()
            text = j._jdf.queryExecution().executedPlan().toString()
            above = text.split("InMemoryTableScan")[0]
            assert "SortMergeJoin" in text and "Exchange" not in above, mode
    finally:
        spark.conf.unset(cache.MODE_CONF)
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_normalized_tables_take_one_shuffle_each(spark):
    from tablewright.operators import normalize as N
    rows = [(o % 9 or None, f"d{o % 9}", o % 9, o % 4, p, o + p) for o in range(40) for p in range(3)] * 2
    flat = spark.createDataFrame(rows, "OrderID int, OrderDate string, OrderTotal int, CustomerID int, CookieID int, Quantity int")
    from pyspark.sql import functions as F
    for c in dict.fromkeys(N.CUSTOMER_COLUMNS[1:] + N.PRODUCT_COLUMNS[1:]):
        flat = flat.withColumn(c, F.concat(F.lit(c), "CustomerID"))
    lines = N.order_lines(flat, 5).persist()
    try:
        made = N.normalize(flat, lines)
        exchanges = {}
        for name, df in vars(made).items():
            df.collect()
            text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            text = text.split("InMemoryTableScan")[0]
            exchanges[name] = text.count("Exchange hashpartitioning")
        assert exchanges == {"customers": 1, "products": 1, "orders": 0, "order_details": 0}
        for name, columns in (("customers", N.CUSTOMER_COLUMNS), ("products", N.PRODUCT_COLUMNS), ("orders", N.ORDER_COLUMNS)):
            got = getattr(made, name).collect()
            assert sorted(got, key=repr) == sorted(set(flat.select(*columns).collect()), key=repr)
        assert made.order_details.count() == len(rows)
    finally:
        lines.unpersist()


def test_a_report_builds_the_tables_it_reads(spark):
    import os
    from tablewright import session
    from tablewright.plans import cache, retail
    cache.release(spark)
    folder = os.path.join(session.shared_dir(spark), "tables")

    def stored():
        return set(os.listdir(folder)) if os.path.exists(folder) else set()

    before = stored()
    spark.conf.set(cache.MODE_CONF, "table")
    try:
        m = retail.model(spark, SF)
        assert stored() == before
        assert m.customers.count() > 0 and len(stored() - before) == 1
        assert m.order_details.count() > 0 and len(stored() - before) == 2
        assert m.orders.count() > 0 and m.products.count() > 0 and len(stored() - before) == 4
    finally:
        cache.release(spark)
        spark.conf.unset(cache.MODE_CONF)


def test_the_flat_file_has_the_recipes_rows_in_every_order_of_joins(spark, tmp_path):
    from tablewright.sources import fixtures
    tables = {
        "region": ([(1, "R"), (2, None)], "r_regionkey int, r_name string"),
        "nation": ([(1, "A", 1), (2, "B", 2), (3, "C", None)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "c1", 1), (1, "c1", 2), (2, None, 2), (3, "c3", 3), (None, "c", 1)],
                     "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(1, "p1", 3, 2.5), (1, "p1b", 4, 2.5), (2, "p2", None, None), (None, "p", 1, 1.0)],
                 "p_partkey long, p_name string, p_size int, p_retailprice double"),
        "orders": ([(1, 1, 5.0), (1, 2, 5.0), (2, 2, None), (3, 3, 1.0), (4, None, 1.0), (None, 1, 1.0)],
                   "o_orderkey long, o_custkey long, o_totalprice double"),
        "lineitem": ([(o, p, q) for o in (1, 2, 3, 4, None) for p in (1, 2, None) for q in (1.0, None)],
                     "l_orderkey long, l_partkey long, l_quantity double"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        if name == "orders":
            df = df.selectExpr("*", "timestamp'2000-01-01 10:00:00' AS o_orderdate")
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    want = sorted(fixtures.fixture(spark, str(tmp_path), "flat_file").collect(), key=str)
    assert len(want) > 20
    for last in fixtures.FLAT_JOINS:
        got = fixtures.flat_file(spark, str(tmp_path), last)
        assert sorted(got.collect(), key=str) == want, last


def test_customers_are_joined_to_orders_before_their_details(spark):
    text = entry.queries()["order_breakdown"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join Inner, (OrderID") < text.index("Join Inner, (CustomerID")
