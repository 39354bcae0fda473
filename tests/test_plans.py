"""Plan properties: column pruning, pushed filters, partition pruning, JVM-only paths."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from corpusflow.operators import state as ST
from corpusflow.schemas import BOOK_STATE, STATE_COLUMNS
from corpusflow.sources import state as SS

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    p = plan_of(E.queries()["slugify"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_status_filter_reaches_parquet(spark):
    p = plan_of(E.queries()["state_upsert"](spark, SF))
    assert "PushedFilters: [In(o_orderstatus, [F,O])" in p or "PushedFilters: [IsNotNull(o_orderstatus), In(o_orderstatus, [F,O])" in p


def test_pending_filter_and_page_pruning_on_state(spark, tmp_path):
    rows = [tuple({"page_slug": p, "id": str(i), "status": s}.get(c) for c in STATE_COLUMNS) for p in ("a", "b") for i, s in enumerate(["completed", None, "failed"])]
    root = str(tmp_path / "st")
    SS.save_state(spark.createDataFrame(rows, BOOK_STATE), root)
    st = SS.load_state(spark, root)
    pending = ST.pending_books(st).filter(F.col("page_slug") == "a")
    p = plan_of(pending)
    assert "EqualTo(page_slug,a)" in p and "Not(EqualNullSafe(status,completed))" in p
    assert sorted(r.id for r in pending.collect()) == ["1", "2"]


def test_column_functions_stay_in_the_jvm(spark):
    for key in ["slugify", "url_join", "url_quote", "page_slug", "book_paths", "limit_per_page", "resolved_urls"]:
        p = plan_of(E.queries()[key](spark, SF))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p and "MapInPandas" not in p, key


def test_handler_list_is_compiled_not_joined(spark):
    p = plan_of(E.queries()["resolve_handler"](spark, SF))
    assert "Join" not in p and "Exchange" not in p


def test_no_columns_built_at_import_time():
    """Python workers import library modules to unpickle functions; a Column built at
    module level needs a SparkContext there and fails the task."""
    import ast
    import os

    import corpusflow

    root = os.path.dirname(corpusflow.__file__)
    offenders = []
    for d, _, files in os.walk(root):
        for f in files:
            if f.endswith(".py"):
                tree = ast.parse(open(os.path.join(d, f), encoding="utf-8").read())
                for node in tree.body:
                    if isinstance(node, (ast.Assign, ast.AnnAssign, ast.Expr)):
                        for sub in ast.walk(node):
                            if isinstance(sub, ast.Call) and isinstance(sub.func, ast.Attribute) and getattr(sub.func.value, "id", None) == "F":
                                offenders.append(f"{f}:{node.lineno}")
    assert offenders == []


def test_no_self_joins_for_carried_columns(spark):
    for key in ["chunk_names", "precheck_placeholder", "sort_metadata", "merge_metadata"]:
        assert "Join" not in plan_of(E.queries()[key](spark, SF)), key
