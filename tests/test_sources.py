import os

import pytest
from pyspark.sql import functions as F

from checks.registry import raw_loans
from small_tables import SMALL, rows
from ledgerlark import schema as S
from ledgerlark.operators import clean as K
from ledgerlark.operators import identity as I
from ledgerlark.operators import quality as Q
from ledgerlark.operators.quality import profile_nulls
from ledgerlark.plans import factorised as X
from ledgerlark.plans import marts as M
from ledgerlark.plans import unified as U
from ledgerlark.plans.pipeline import CLEAN_TABLES, Run, export_csv, release_tables, run_pipeline, run_stages
from ledgerlark.operators.scoring import score_pipeline
from ledgerlark.sources import readers, scratch, writers


MARTS = (*M.SHARES, *M.RATES)


def data_files(path):
    return [f for f in os.listdir(path) if f.startswith("part-")]


def test_positional_names_and_bad_numbers(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("first,second\n1,2.5\nx,y\n,\n")
    df = readers.read_csv_positional(spark, str(path), "a int, b float")
    assert rows(df) == [(None, None), (None, None), (1, 2.5)]
    kept = readers.read_csv_positional(spark, str(path), "a int, b float", keep_corrupt=True)
    assert [r._corrupt_record for r in kept.collect() if r._corrupt_record] == ["x,y"]
    # Rows that fit have no corrupt text: counted along with the NULLs of every column.
    assert profile_nulls(kept).first().asDict() == {"a": 2, "b": 2, "_corrupt_record": 2}


def test_inferred(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a,b,c\n1,2.5,x\n2,3,y\n")
    assert readers.read_csv_inferred(spark, str(path)).dtypes == [("a", "int"), ("b", "double"), ("c", "string")]


def test_raw_loans_by_header(spark, tmp_path):
    """Columns are found by header name, others are skipped, a bad number is NULL."""
    raw = raw_loans(spark, SMALL)
    shuffled = raw.select(F.lit("x").alias("unused"), *reversed(raw.columns))
    shuffled.write.csv(str(tmp_path / "raw"), header=True, ignoreLeadingWhiteSpace=False)
    back = readers.read_raw_loans(spark, str(tmp_path / "raw"))
    assert back.dtypes == [(c, t) for c, t in S.RAW_COLUMNS.items()]
    assert rows(back) == rows(raw)
    scan = back.select("grade")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<grade:string>" in scan


def test_single_file_at_any_size(spark, tmp_path):
    df = spark.range(100).repartition(4)
    writers.write_csv_single(df, str(tmp_path / "one"))
    assert len(data_files(tmp_path / "one")) == 1
    assert rows(spark.read.schema("id long").csv(str(tmp_path / "one"), header=True)) == rows(df)


def test_table_replaced_and_widened(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 1.5)], "k string, i int, f float")
    for options in (None, {"path": str(tmp_path / "t")}):
        name = f"t_{'path' if options else 'managed'}"
        writers.write_table(df, name, options=options)
        writers.write_table(df, name, options=options)
        table = readers.read_table(spark, name)
        assert table.dtypes == [("k", "string"), ("i", "bigint"), ("f", "double")]
        assert rows(table) == [("a", 1, 1.5)]


def test_connector_format_is_a_parameter(spark, tmp_path):
    """A path-based format stands in for a connector: the name goes in as its `table` option."""
    df = spark.createDataFrame([("a", 1)], "k string, i int")
    path = str(tmp_path / "orc")
    writers.write_table(df, "ignored", fmt="orc", options={"path": path})
    assert rows(readers.read_table(spark, "ignored", fmt="orc", options={"path": path})) == [("a", 1)]


def test_partitioned_table(spark, tables):
    name = "loans_partitioned"
    loans = tables["loans"]
    writers.write_partitioned(loans, name)
    table = spark.table(name)
    assert rows(table.drop("issue_year")) == rows(loans)
    plan = table.where("issue_year = 1998")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(issue_year" in plan
    one = table.where("member_id = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(member_id,x)" in one


def test_hot_member_is_in_several_files(spark, tables):
    loans = tables["loans"].withColumn("member_id", F.lit("hot"))
    # At this size the runtime would merge all ranges into one task.
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        writers.write_partitioned(loans, "loans_hot")
    finally:
        spark.conf.unset(merging)
    files = spark.table("loans_hot").select("issue_year", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("issue_year").count().agg(F.max("count")).first()[0] > 1


def test_published_table_is_replaced(spark, tables):
    loans = tables["loans"]
    part = loans.limit(50)
    writers.write_partitioned(loans, "loans_again")
    writers.write_partitioned(part, "loans_again")
    assert spark.table("loans_again").count() == 50


def test_partitioned_table_replaces_only_given_years(spark, tables):
    name = "loans_by_year"
    loans = tables["loans"]
    writers.write_partitioned(loans, name)
    one_year = writers.add_issue_year(loans).where("issue_year = 1998").drop("issue_year")
    assert one_year.count() > 1
    changed = one_year.withColumn("loan_title", F.lit("changed"))
    writers.write_partitioned(changed, name, years_only=True)
    table = spark.table(name)
    assert table.count() == loans.count()
    assert table.where("loan_title = 'changed'").count() == one_year.count()
    assert table.where("issue_year <> 1998 AND loan_title = 'changed'").count() == 0


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch.scratch_root(spark) == spark.conf.get(scratch.CHECKPOINT_CONF)
    one, two = scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "x")
    assert one != two and one.startswith(scratch.scratch_root(spark))


def test_materialized_table_has_no_lineage(spark):
    df = spark.range(10).repartition(3)
    stored = scratch.materialize(df, "range")
    assert rows(stored) == rows(df)
    assert "Exchange" not in stored._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pipeline(spark, tmp_path_factory):
    target = tmp_path_factory.mktemp("out")
    return target, run_pipeline(raw_loans(spark, SMALL), str(target))


def test_pipeline_writes_every_table(spark, pipeline):
    target, result = pipeline
    names = {
        *CLEAN_TABLES, "profiles", "records_enquiries", "member_state", "member_counts", "bad_members",
        "bad_customers", "bad_delinq", "bad_detail", "customers_new", "delinq_new", "detail_new",
        "unified_factors", "loan_score", "fact_loan", "dim_customer", "dim_issue_month", "star_summary",
        "mart_cube", *MARTS, "mart_issue_trend", "mart_repayment_trend", "mart_score_histogram",
        "mart_risk_category",
    }
    assert set(result) == names
    for name in names:
        assert spark.read.parquet(str(target / name)).count() == result[name].count()


def test_pipeline_tables_equal_the_operators(spark, tables, pipeline):
    result = pipeline[1]
    three = {n: tables[n] for n in ("customers", "delinq", "detail")}
    assert rows(result["bad_members"]) == rows(Q.bad_members(three))
    assert rows(result["bad_delinq"]) == rows(Q.duplicate_keys(tables["delinq"]))
    for name in three:
        got = result[f"{name}_new"].drop("ingest_date")
        assert rows(got) == rows(Q.without_repeated(name, three).drop("ingest_date"))
    assert X.wide_rows(result["unified_factors"]).count() == U.unified_table(tables).count()
    for name in MARTS:
        arguments = [tables["loans"]] if name in ("mart_status_share", "mart_purpose_share") else [
            tables["loans"], tables["customers"]]
        assert rows(result[name]) == rows(getattr(M, name)(*arguments)), name


def test_profiles_equal_the_scans(spark, tables, pipeline):
    """Counts taken along by the writes equal those of queries of their own."""
    found = {(r.table_name, r.step, r.metric): r.n for r in pipeline[1]["profiles"].collect()}
    keyed = I.member_identity(raw_loans(spark, SMALL))
    repayments = I.repayments_entity(keyed)
    for column, n in Q.profile_nulls(repayments).first().asDict().items():
        assert found["repayments", "raw", f"null {column}"] == n
    kept = repayments.na.drop(subset=list(S.REPAYMENT_REQUIRED))
    for rule, n in Q.profile_rules(kept, Q.repayment_rules()).first().asDict().items():
        assert found["repayments", "raw", f"rule {rule}"] == n
    distinct = Q.distinct_rows(K.rename_customers(I.customers_entity(keyed)))
    for rule, n in Q.profile_rules(distinct, Q.customer_rules()).first().asDict().items():
        assert found["customers", "distinct", f"rule {rule}"] == n
    for name in CLEAN_TABLES:
        df = tables[name].drop("ingest_date")
        assert found[name, "clean", "rows"] == df.count()
        for column, n in Q.profile_nulls(df).first().asDict().items():
            assert found[name, "clean", f"null {column}"] == n


def test_stages_start_from_stored_tables(spark, tables, pipeline):
    target = str(pipeline[0])
    again = run_stages(Run(spark, target, wide="none"), ["marts", "score"])
    assert rows(again["loan_score"]) == rows(score_pipeline(tables))
    assert "mart_cube" in again and "customers" not in again
    with pytest.raises(ValueError, match="unknown stages"):
        run_stages(Run(spark, target), ["scores"])
    with pytest.raises(ValueError, match="raw rows"):
        run_stages(Run(spark, target), ["clean"])


def test_tables_are_released_together(spark, pipeline):
    some = {n: pipeline[1][n] for n in ("loans", "customers_new", "unified_factors", "bad_members")}
    release_tables(spark, some, "rls_")
    for name in ("customers_new", "bad_members"):
        assert spark.table(f"rls_{name}").count() == some[name].count()
    assert spark.table("rls_unified").count() == X.wide_rows(some["unified_factors"]).count()
    assert "issue_year" in spark.table("rls_loans").columns


def test_pipeline_scores(tables, pipeline):
    assert rows(pipeline[1]["loan_score"]) == rows(score_pipeline(tables))


def test_export(spark, pipeline, tmp_path):
    export_csv({"bad_members": pipeline[1]["bad_members"]}, str(tmp_path))
    back = spark.read.csv(str(tmp_path / "bad_members"), header=True)
    assert rows(back) == rows(pipeline[1]["bad_members"])


def test_command_line(spark, tables, tmp_path):
    """Raw CSV in; Parquet, CSV and warehouse tables out, with the same scores; then one stage again."""
    from ledgerlark.__main__ import main

    raw_loans(spark, SMALL).write.csv(str(tmp_path / "raw"), header=True, ignoreLeadingWhiteSpace=False)
    target, copies = str(tmp_path / "out"), str(tmp_path / "csv")
    stages = [part for name in ("clean", "count", "score") for part in ("--stage", name)]
    main([target, "--raw", str(tmp_path / "raw"), *stages, "--csv", copies, "--tables", "cli_"])
    expected = rows(score_pipeline(tables))
    assert rows(spark.read.parquet(f"{target}/loan_score")) == expected
    assert rows(spark.table("cli_loan_score")) == expected
    assert spark.table("cli_loans").count() == tables["loans"].count()
    assert spark.read.csv(f"{copies}/loan_score", header=True).count() == len(expected)
    assert not os.path.exists(f"{copies}/member_state")
    main([target, "--stage", "quality", "--release", "cli2_"])
    assert spark.table("cli2_detail_new").count() == Q.without_repeated(
        "detail", {n: tables[n] for n in ("customers", "delinq", "detail")}).count()
    orc = f"path={tmp_path / 'orc'}"
    main([target, "--stage", "score", "--tables", "x_", "--format", "orc", "--option", orc])
    assert spark.read.orc(str(tmp_path / "orc")).count() > 0
    for wrong in (["--stage", "clean"], ["--option", "path"]):
        with pytest.raises(SystemExit):
            main([target, *wrong])
