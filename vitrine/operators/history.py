"""Last-known values: history windows and the backfill of blank fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import models as D
from vitrine.functions.text import (
    append_token, as_text, blank, has_token, null_if_blank, present, squash,
)
from vitrine.functions.urls import url_item_key
from vitrine.operators.numbering import first_rows, spread_blank
from vitrine.operators.relevance import is_standalone_dryer

# Fields the history may fill, by product line.
LAST_KNOWN_FIELDS = {
    "TV": ("sku", "screen_size", "estimated_annual_electricity_use", "model_year"),
    "REF": ("sku", "ref_refrigerator_type", "ref_capacity"),
    "LDY": ("sku", "ldy_loading_type", "ldy_color", "ldy_capacity"),
}


def history_window(history: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """Latest ``k`` rows per key; blanks of an order column come last."""
    by = [F.desc_nulls_last(null_if_blank(F.col(c))) for c in order]
    return first_rows(history, keys, by, max(1, int(k)), "history_rank")


def _latest(value: Column, order: list[str]) -> Column:
    """Value of the newest row that has one; blanks of an order column are older than all else.

    One aggregate over all rows of a key: it combines before the shuffle, however long the history is.
    """
    age = F.struct(*[null_if_blank(F.col(c)).alias(c) for c in order])
    return F.max_by(value, F.when(value.isNotNull(), age))


def last_known(history: DataFrame, keys: list[str], fields: list[str], order: list[str]) -> DataFrame:
    """Per key and per field independently: the newest non-blank value."""
    return history.groupBy(*keys).agg(*[_latest(null_if_blank(F.col(f)), order).alias(f) for f in fields])


def valid_history_sku(line: str, row: dict[str, Column]) -> Column:
    """The SKU a history row may contribute, NULL when its line rejects it."""
    title, sku = row["retailer_sku_name"], D.normalize_sku(row["sku"])
    if line == "REF":
        # a full model stored in the short column counts when the title proves it
        legacy = D.normalize_sku(row["sku_short_version"])
        from_title = D.refrigerator_choice(D.refrigerator_candidates(title, F.lit("")), title)
        promoted = (legacy != "") & (legacy == from_title)
        return F.when(D.is_valid_refrigerator_sku(sku, title), sku).when(promoted, legacy)
    if line == "LDY":
        return F.when(D.is_valid_washer_sku(sku), sku)
    plain = F.trim(as_text(row["sku"]))
    same_as_title = present(title) & (F.lower(squash(plain)) == F.lower(squash(title)))
    return F.when((plain != "") & ~same_as_title & (F.lower(plain) != row["item_key"]), plain)


def identity_conflict(status: Column, line: Column) -> Column:
    low = F.lower(as_text(status))
    return (
        F.contains(low, F.lit("identity_mismatch")) | F.contains(low, F.lit("identity_conflict"))
        | ((line == "TV") & F.contains(low, F.lit("sku_mismatch")))
    )


def backfill(rows: DataFrame, history: DataFrame, keys: list[str], fields: list[str],
             needs: dict[str, Column], values: dict[str, Column], order: list[str],
             valid: Column) -> DataFrame:
    """Fill fields of ``rows`` from the history, blanks (or unproven values) only.

    ``needs`` says per field when a row wants it; ``values`` is what a history row
    offers for it (NULL when nothing valid); ``valid`` checks a history row.  All rows of a
    key are looked at.   Adds ``recovered`` (field names).
    """
    wanted = rows.withColumns({f"__need_{f}": F.coalesce(needs[f], F.lit(False)) for f in fields})
    any_need = reduce(lambda a, b: a | b, [F.col(f"__need_{f}") for f in fields])
    offered = history.filter(valid).withColumns({f"__v_{f}": values[f] for f in fields})
    known = offered.groupBy(*keys).agg(
        *[_latest(F.col(f"__v_{f}"), order).alias(f"__known_{f}") for f in fields]
    )
    # rows that ask for nothing match nothing, and are dealt over all tasks
    first = spread_blank(F.when(any_need, F.col(keys[0]).cast("string")))
    right = known.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [
        (F.col("__ask") if k == keys[0] else F.col(k)) == F.col(f"__k_{k}").cast("string") for k in keys])
    out = wanted.withColumn("__ask", first).join(right, match, "left").drop("__ask", *[f"__k_{k}" for k in keys])
    hit = {f: F.col(f"__need_{f}") & F.col(f"__known_{f}").isNotNull() for f in fields}
    filled = {f: F.when(hit[f], F.col(f"__known_{f}")).otherwise(F.col(f)) for f in fields}
    recovered = F.array_compact(F.array(*[F.when(hit[f], F.lit(f)) for f in fields]))
    drop = [f"__need_{f}" for f in fields] + [f"__known_{f}" for f in fields]
    return out.withColumns({**filled, "recovered": recovered}).drop(*drop)


def backfill_line(rows: DataFrame, history: DataFrame, line: str, layout: str, hosts: list[str]) -> DataFrame:
    """History backfill of one product line and layout, SKU rules included.

    Both sides carry the published columns; ``item_key`` is derived on both.
    """
    fields = list(LAST_KNOWN_FIELDS[line])
    key = url_item_key(F.col("product_url"), F.col("item"), hosts)
    rows, history = rows.withColumn("item_key", key), history.withColumn("valid_key", key)
    history = history.withColumn("item_key", F.lower(F.trim(as_text(F.col("item")))))
    row = {c: F.col(c) for c in rows.columns}
    conflict = identity_conflict(row["parse_status"], F.lit(line)) & F.lit(layout == "C")
    dryer = is_standalone_dryer(row["retailer_sku_name"]) & F.lit(line == "LDY" and layout == "C")
    needs = {}
    for f in fields:
        if f == "sku":
            need = sku_needs_recovery(row, layout, line, hosts)
        else:
            need = blank(row[f]) & ~conflict
            if f in ("ldy_capacity", "ldy_loading_type"):
                need = need & ~dryer
        needs[f] = (row["item_key"] != "") & need
    offered = {c: F.col(c) for c in history.columns}
    values = {
        f: valid_history_sku(line, offered) if f == "sku" and layout == "C"
        else null_if_blank(offered[f])
        for f in fields
    }
    out = backfill(rows, history, ["item_key"], fields, needs, values,
                   ["crawl_strdatetime", "batch_id", "product_url"],
                   F.col("valid_key") == F.col("item_key"))
    token = {"REF": D.REF_LAST_KNOWN, "LDY": D.LDY_LAST_KNOWN, "TV": D.TV_LAST_KNOWN}[line]
    if layout == "C":
        got = F.array_contains("recovered", "sku")
        out = out.withColumn(
            "parse_status",
            F.when(got, append_token(F.col("parse_status"), token)).otherwise(F.col("parse_status")),
        )
        if line != "TV":
            now = {c: F.col(c) for c in out.columns}
            short = D.short_for_output(now, now["sku"], "C", line, F.lit(""))
            out = out.withColumn("sku_short_version", F.when(got, short).otherwise(now["sku_short_version"]))
    return out


def sku_needs_recovery(row: dict[str, Column], layout: str, line: str, hosts) -> Column:
    """The published SKU would be blank."""
    keyed = {**row, "item": row["item_key"]}
    if layout == "M":
        keyed["sku"] = F.when(F.lower(F.trim(as_text(row["sku"]))) == row["item_key"], "").otherwise(
            as_text(row["sku"])
        ) if line != "TV" else row["sku"]
    shown = D.sku_for_output(keyed, layout, line, hosts, F.lit(""), F.lit(False))
    if layout == "M" and line == "TV":
        same = F.lower(F.trim(as_text(row["sku"]))) == row["item_key"]
        return (shown == "") | (same & ~has_token(row["parse_status"], D.TV_REFERENCE))
    return shown == ""


def recovery_counters(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, recovered rows and recovered fields per run."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.size("recovered") > 0).alias("recovered_rows"),
        F.coalesce(F.sum(F.size("recovered")), F.lit(0)).alias("recovered_fields"),
    )


def recovered_by_field(rows: DataFrame, keys: list[str]) -> DataFrame:
    return (
        rows.select(*keys, F.explode("recovered").alias("field"))
        .groupBy(*keys, "field").agg(F.count(F.lit(1)).alias("recovered_rows"))
    )
