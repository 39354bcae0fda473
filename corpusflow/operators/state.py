"""Book-state operators: keyed upsert, checksum verdicts, filters, ranking, the stage
state machine, resets and resume plans. All are DataFrame -> DataFrame.

Keys are ``(page_slug, id)``; the reference keeps one state file per page and keys
by id inside it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import zfill_id
from corpusflow.operators.ranking import number_within
from corpusflow.schemas import COMPLETED, FAILED, IN_PROGRESS, PENDING, STAGE_NAMES, STAGES

KEYS = ["page_slug", "id"]
# Columns a re-scan overwrites on a matched row (the rest keep their old values).
OVERWRITE_ON_MATCH = ["pdf_url", "local_pdf_path", "local_md_path", "local_docx_path"]


def not_equal_null_safe(c, value: str) -> Column:
    """``x != value`` where a missing value counts as different (Python ``dict.get``)."""
    col = F.col(c) if isinstance(c, str) else c
    return ~col.eqNullSafe(F.lit(value))


def same_keys(a: DataFrame, b: DataFrame, keys: list[str], of_b: str = "") -> Column:
    """Join condition over ``keys`` (in ``b`` with prefix ``of_b``); a null key equals a null key, as it
    does in a grouping, so a row without id is matched again and not inserted once more."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"{of_b}{k}"]) for k in keys])


# --- J2 / U1: keyed upsert ----------------------------------------------------


def dedupe_batch(incoming: DataFrame, keys: list[str], seq_col: str) -> tuple[DataFrame, DataFrame]:
    """Within one incoming batch the last row per key (by ``seq_col``; ties broken by
    the row's other values, so the choice is deterministic) wins; every other row is a
    reject — nothing is dropped. Partial aggregation keeps a hot key map-side."""
    cols = [c for c in incoming.columns if c not in keys]
    rest = [c for c in cols if c != seq_col]
    order = F.struct(F.col(seq_col), *[F.col(c) for c in rest])
    last = incoming.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("_r"))
    winners = last.select(*keys, "_r.*").select(*incoming.columns)
    rejects = incoming.exceptAll(winners)
    return winners, rejects


def state_upsert(
    state: DataFrame,
    incoming: DataFrame,
    keys: list[str] = KEYS,
    overwrite: list[str] = OVERWRITE_ON_MATCH,
    insert_status: str = PENDING,
) -> DataFrame:
    """Merge a catalogue batch (one row per key) into state.

    matched -> only ``overwrite`` columns take the new values, everything else (titles,
    slugs, statuses, hash) keeps the old value, nulls included; not matched by source
    -> kept; new -> inserted whole with status ``insert_status`` when it has none.

    One full outer join on the keys: either side is read once and shuffled once (not at all
    when both are bucketed on the keys)."""
    cols = list(dict.fromkeys(list(state.columns) + [c for c in incoming.columns if c not in state.columns]))
    o = state.select(*[F.col(c).alias(f"o_{c}") for c in state.columns], F.lit(True).alias("_o"))
    n = incoming.select(*[F.col(c).alias(f"n_{c}") for c in incoming.columns], F.lit(True).alias("_n"))
    cond = reduce(lambda a, b: a & b, [o[f"o_{k}"].eqNullSafe(n[f"n_{k}"]) for k in keys])
    has_o = F.coalesce(F.col("_o"), F.lit(False))
    has_n = F.coalesce(F.col("_n"), F.lit(False))

    def pick(c: str) -> Column:
        oc = F.col(f"o_{c}") if c in state.columns else F.lit(None)
        nc = F.col(f"n_{c}") if c in incoming.columns else F.lit(None)
        if c in keys:
            return F.coalesce(oc, nc)
        if c in overwrite:
            return F.when(has_n, nc).otherwise(oc)
        if c == "status":
            return F.when(has_o, oc).otherwise(F.coalesce(nc, F.lit(insert_status)))
        return F.when(has_o, oc).otherwise(nc)

    return o.join(n, cond, "full_outer").select(*[pick(c).alias(c) for c in cols])


def new_books(state: DataFrame, incoming: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Incoming rows whose key is not in state (appended by the upsert)."""
    known = state.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return incoming.join(known, same_keys(incoming, known, keys, "_"), "left_anti")


# --- J4: checksum verdicts -----------------------------------------------------

VERIFIED, ADOPTED, REFETCH, MISSING = "verified", "adopted", "refetch", "missing"


def checksum_verdict(present, current_hash, recorded_hash) -> Column:
    """File vs recorded hash. equal -> verified; no recorded hash -> adopted;
    differs or unreadable -> refetch; file absent -> missing."""
    p = F.col(present) if isinstance(present, str) else present
    cur = F.col(current_hash) if isinstance(current_hash, str) else current_hash
    rec = F.col(recorded_hash) if isinstance(recorded_hash, str) else recorded_hash
    return (
        F.when(~p, F.lit(MISSING))
        .when(cur.isNull(), F.lit(REFETCH))
        .when(F.coalesce(rec, F.lit("")) == F.lit(""), F.lit(ADOPTED))
        .when(cur == rec, F.lit(VERIFIED))
        .otherwise(F.lit(REFETCH))
    )


def hash_after_check(verdict, current_hash, recorded_hash) -> Column:
    """Hash kept in state after the check: the file's hash when verified/adopted; a
    refetch/missing row keeps the recorded one until a download replaces it."""
    v = F.col(verdict) if isinstance(verdict, str) else verdict
    cur = F.col(current_hash) if isinstance(current_hash, str) else current_hash
    rec = F.col(recorded_hash) if isinstance(recorded_hash, str) else recorded_hash
    return F.when(v.isin(VERIFIED, ADOPTED), cur).otherwise(rec)


def hash_after_fetch(fetched_hash, old_hash) -> Column:
    """After a fetch the new hash replaces the old one without comparison."""
    return F.coalesce(F.col(fetched_hash), F.col(old_hash))


# --- filters -------------------------------------------------------------------


def pending_books(state: DataFrame) -> DataFrame:
    """status is not 'completed' (a missing status is kept)."""
    return state.filter(not_equal_null_safe("status", COMPLETED))


def resettable(state: DataFrame, target_page: str | None = None) -> Column:
    """F6 predicate: status failed or in_progress, optionally on one page."""
    p = F.col("status").isin(FAILED, IN_PROGRESS)
    if target_page is not None:
        p = p & (F.col("page_slug") == F.lit(target_page))
    return F.coalesce(p, F.lit(False))


def remaining_stages(df: DataFrame) -> Column:
    """stages whose status is not 'completed', in pipeline order."""
    arr = F.array(*[F.when(not_equal_null_safe(c, COMPLETED), F.lit(n)) for c, n in zip(STAGES, STAGE_NAMES)])
    return F.filter(arr, lambda x: x.isNotNull())


# --- ranking -------------------------------------------------------------------


def sort_books(state: DataFrame, keys: list[str] = ["page_slug"], out: str = "sort_rank") -> DataFrame:
    """O1: position of each row by the string order of zfill(3) id (ties: id)."""
    z = state.withColumn("_zid", zfill_id("id"))
    return number_within(z, keys, ["_zid", "id"], out=out).drop("_zid")


def page_limits(limits: DataFrame, page_col: str = "page_slug", order: list[str] | None = None) -> DataFrame:
    """One limit per page slug: two config pages with one slug share a state, and the first
    in ``order`` (config order) gives the limit; without an order the least positive limit
    does, "no limit" (null or 0) counting as the largest."""
    if order:
        least = F.min(F.struct(*order, F.col("limit")))
    else:
        size = F.when(F.coalesce(F.col("limit"), F.lit(0)) > 0, F.col("limit")).otherwise(F.lit((1 << 31) - 1))
        least = F.min(F.struct(size.alias("_s"), F.col("limit")))
    return limits.groupBy(page_col).agg(least.alias("_l")).select(page_col, F.col("_l.limit").alias("limit"))


def limit_per_page(pending: DataFrame, limits: DataFrame, page_col: str = "page_slug", order: list[str] | None = None) -> DataFrame:
    """W2 + W3: in zfill-id order, the first ``limit`` rows of each page (null or 0 ->
    no limit), with ``ordinal`` (1-based) and ``total`` (rows kept on the page).

    Limits are reduced to one row per slug first (``page_limits``), so the join never
    repeats a pending row. Every page is numbered by the skew-safe numbering, whatever its
    limit: a hot page spans many tasks."""
    table = page_limits(limits, page_col, order).select(F.col(page_col).alias("_lp"), F.col("limit").alias("_limit"))
    z = pending.withColumn("_zid", zfill_id("id"))
    ranked = number_within(z, [page_col], ["_zid", "id"], out="ordinal", total="_n")
    j = ranked.join(table, ranked[page_col] == table["_lp"], "left").drop("_lp")
    limited = F.coalesce(F.col("_limit"), F.lit(0)) > 0
    total = F.when(~limited, F.col("_n")).otherwise(F.least(F.col("_n"), F.col("_limit").cast("bigint")))
    return j.filter(~limited | (F.col("ordinal") <= F.col("_limit"))).withColumn("total", total).drop("_limit", "_n", "_zid")


def pending_counts(limited: DataFrame, page_col: str = "page_slug") -> DataFrame:
    """A5: rows to process per page (after the limit)."""
    return limited.groupBy(page_col).agg(F.count(F.lit(1)).alias("n_to_process"))


# --- M1 / M2 / M3 --------------------------------------------------------------


def stage_transition(state: DataFrame, outcomes: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """M1: one pass of the per-book stages over rows that are not completed.

    Evaluated left to right: download failure -> failed (stop); OCR failure -> failed
    (stop); conversion outcome only sets its stage; the book is completed iff the md copy
    and the docx copy both succeed (the raw copy is ignored; without a converted docx
    there is nothing to copy, so the status stays). Completed stages are not redone; rows
    without an outcome row (not processed in this pass) are unchanged. Several outcome rows
    of one key count as one pass: a stage succeeded only if none of them reports a failure."""
    steps = [c for c in outcomes.columns if c not in keys]
    outs = outcomes.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*[F.bool_and(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in steps]).withColumn("_has_outcome", F.lit(True))
    j = state.join(outs, same_keys(state, outs, keys, "_"), "left")
    # rows without an outcome were not processed in this pass and stay untouched
    todo = F.coalesce(F.col("_has_outcome"), F.lit(False)) & not_equal_null_safe("status", COMPLETED)
    dl_todo = not_equal_null_safe("download_status", COMPLETED)
    ocr_todo = not_equal_null_safe("ocr_status", COMPLETED)
    dx_todo = not_equal_null_safe("docx_conversion_status", COMPLETED)
    ok = lambda c: F.coalesce(F.col(c), F.lit(False))
    dl_fail = todo & dl_todo & ~ok("download_ok")
    ocr_fail = ~dl_fail & ocr_todo & ~ok("ocr_ok")
    reached = ~dl_fail & ~ocr_fail
    new_dl = F.when(todo & dl_todo & ok("download_ok"), F.lit(COMPLETED)).otherwise(F.col("download_status"))
    new_ocr = F.when(todo & ~dl_fail & ocr_todo & ok("ocr_ok"), F.lit(COMPLETED)).otherwise(F.col("ocr_status"))
    new_dx = F.when(todo & reached & dx_todo & ok("convert_ok"), F.lit(COMPLETED)).otherwise(
        F.col("docx_conversion_status")
    )
    docx_ok = ok("docx_copied") & new_dx.eqNullSafe(F.lit(COMPLETED))
    new_status = (
        F.when(~todo, F.col("status"))
        .when(dl_fail | ocr_fail, F.lit(FAILED))
        .when(ok("md_copied") & docx_ok, F.lit(COMPLETED))
        .otherwise(F.col("status"))
    )
    repl = {"status": new_status, "download_status": new_dl, "ocr_status": new_ocr, "docx_conversion_status": new_dx}
    return j.select(*[repl.get(c, F.col(c)).alias(c) for c in state.columns])


def reset_statuses(state: DataFrame, target_page: str | None = None) -> DataFrame:
    """M2: failed / in-progress rows -> status and the three stage statuses 'pending',
    error_message removed; every other row untouched."""
    hit = resettable(state, target_page)
    repl = {c: F.when(hit, F.lit(PENDING)).otherwise(F.col(c)) for c in ["status", *STAGES]}
    if "error_message" in state.columns:
        repl["error_message"] = F.when(hit, F.lit(None).cast("string")).otherwise(F.col("error_message"))
    return state.select(*[repl.get(c, F.col(c)).alias(c) for c in state.columns])


def reset_counts(state: DataFrame, target_page: str | None = None) -> DataFrame:
    """A4: rows reset per page."""
    return state.groupBy("page_slug").agg(F.count_if(resettable(state, target_page)).cast("bigint").alias("n_reset"))


def resume_plan(state: DataFrame, limits: DataFrame, order: list[str] | None = None) -> DataFrame:
    """M3: per book still to process (after the page limit): ordinal, total and the
    remaining stages in order."""
    limited = limit_per_page(pending_books(state), limits, order=order)
    return limited.withColumn("remaining", remaining_stages(limited))
