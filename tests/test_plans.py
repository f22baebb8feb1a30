"""Plan checks: the shapes the design promises, read from the physical plan."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_is_jvm_only_and_pruned(spark):
    p = plan(spark, "transactions")
    assert "EvalPython" not in p and "BroadcastNestedLoopJoin" not in p and "Window" not in p
    # the contracts scan reads two columns
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in p


def test_md4_flagship_uses_one_arrow_udf(spark):
    p = plan(spark, "transactions_md4")
    assert p.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in p


def test_priority_merge_is_an_aggregate_not_a_window(spark):
    p = plan(spark, "priority_merge")
    assert "Window" not in p and "min_by" in p


def test_rank_has_no_global_sort_of_rows(spark):
    p = plan(spark, "value_rank")
    # the only single-partition window is over per-bucket totals (≤ buckets rows)
    assert "rangepartitioning" not in p.lower()


def test_lookup_is_an_equi_join_on_one_row_a_key(spark):
    p = plan(spark, "lookup_effective")
    assert "Join [" in p and "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_quantile_breaks_are_no_join(spark):
    for name in ("quantile_class", "pivot_centered"):
        p = plan(spark, name)
        assert "NestedLoop" not in p and "CartesianProduct" not in p


def test_message_regex_runs_once_per_message(spark):
    for name in ("mt103_typed", "mt103_fields", "mt103_long"):
        assert plan(spark, name).count("regexp_extract_all") == 3, name  # keys and contents of blocks, tags of fields


def test_country_assembly_reads_its_observations_once(spark):
    assert "orders.parquet" not in plan(spark, "country_assembly")


def test_documents_group_narrow_rows(spark):
    for name in ("norm_sdmx", "norm_sdmx_filtered", "norm_jsonstat"):
        p = plan(spark, name)
        keys = [line.split("functions=")[0] for line in p.splitlines() if "Aggregate(keys=" in line]
        assert "Window" not in p and keys and not any("v_t" in k for k in keys), name  # no list of a document travels with its cells


def test_reject_reasons_are_evaluated_once(spark):
    assert plan(spark, "reject_rows").count("CLAIM_TYPE#") > 0
    from lakeloom.operators import quality as Q
    from lakeloom.plans.standins import claims_dirty_v
    _, rejected = Q.split_rejects(claims_dirty_v(spark, SF), Q.claims_checks("dd.MM.yyyy", "dd.MM.yyyy HH:mm"))
    tree = rejected._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("amount_not_decimal") == 1


def test_contract_join_has_two_plain_keys(spark):
    p = plan(spark, "join_contracts")
    joins = [line for line in p.splitlines() if "Join [" in line]
    assert joins and not any("struct" in line for line in joins)
