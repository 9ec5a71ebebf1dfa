"""Risk scoring: summary text, default explainable scorer, reply parsing, action ladder.

The source pipeline scores each transaction with a hosted language model. That model's formula is
not recoverable, so the default scorer here is a deterministic column formula over the silver flags
and the fraud-signature weights (ours). An external scorer can be plugged in; it runs per Arrow
batch through ``mapInPandas`` and its replies go through the same parsing, validation, fallback
and ladder as in the source pipeline.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from riskflow.constants import (
    ACTION_LADDER,
    DEFAULT_ACTION,
    FALLBACK_ACTION,
    FALLBACK_LEVEL,
    FALLBACK_SCORE,
    FRAUD_SIGNATURE_ROWS,
    HIGH_VALUE_AMOUNT,
    PROMPT_FOOTER,
    PROMPT_SIGNATURES_HEADER,
    PROMPT_TRANSACTION_HEADER,
    SUMMARY_AMOUNT_PREFIX,
    SUMMARY_FALLBACK,
    SUMMARY_IP,
    SUMMARY_MFA,
    SUMMARY_TYPE_PREFIX,
    SUMMARY_WIRE,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _true(x) -> Column:
    return F.coalesce(_c(x), F.lit(False))


# ---- summary text (the similarity-search query and the scorer's input) --------------------------


def summary_text(
    transaction_type="transaction_type",
    amount="amount",
    mfa="mfa_change_flag",
    ip_recent="ip_changed_recently",
    hv_wire="high_value_wire",
) -> Column:
    """Fixed-order phrases joined by a space, or the fallback sentence when none apply.

    Amounts print with two decimals (the source used the language's default number format).
    """
    t = _c(transaction_type)
    parts = F.concat_ws(
        " ",
        F.when(F.coalesce(t, F.lit("")) != "", F.concat(F.lit(SUMMARY_TYPE_PREFIX), t)),
        F.when(_c(amount).isNotNull(), F.concat(F.lit(SUMMARY_AMOUNT_PREFIX), F.format_string("%.2f", _c(amount)))),
        F.when(_true(mfa), F.lit(SUMMARY_MFA)),
        F.when(_true(ip_recent), F.lit(SUMMARY_IP)),
        F.when(_true(hv_wire), F.lit(SUMMARY_WIRE)),
    )
    return F.coalesce(F.nullif(parts, F.lit("")), F.lit(SUMMARY_FALLBACK))


def transaction_summary(activity: DataFrame) -> DataFrame:
    return activity.select("transaction_id", "user_id", summary_text().alias("summary"))


# ---- levels and actions ---------------------------------------------------------------------------


def risk_action(level="risk_level", score="risk_score") -> Column:
    """First match wins: CRITICAL or >= 85 → BLOCK; HIGH or >= 70 → CHALLENGE; MEDIUM or >= 50 →
    MONITOR; otherwise APPROVE."""
    lvl, sc = _c(level), _c(score)
    expr = None
    for name, minimum, action in ACTION_LADDER:
        cond = (lvl == F.lit(name)) | (sc >= F.lit(minimum))
        expr = F.when(cond, F.lit(action)) if expr is None else expr.when(cond, F.lit(action))
    return expr.otherwise(F.lit(DEFAULT_ACTION))


def risk_level(score="risk_score") -> Column:
    """Level implied by the ladder's score bands (85 / 70 / 50)."""
    sc = _c(score)
    expr = None
    for name, minimum, _ in ACTION_LADDER:
        expr = F.when(sc >= F.lit(minimum), F.lit(name)) if expr is None else expr.when(sc >= F.lit(minimum), F.lit(name))
    return expr.otherwise(F.lit("LOW"))


# ---- default scorer -------------------------------------------------------------------------------

# Rules (ours) mapping silver flags to signature types, in output order.
def _signature_rules(has_travel: Column) -> list[tuple[str, Column]]:
    return [
        ("high_value_wire_ip_change", _true("wire_over_10k_within_1h_ip_change")),
        (
            "mfa_change_high_value",
            _true("mfa_change_flag")
            & _true(F.col("amount") >= HIGH_VALUE_AMOUNT)
            & _true(F.col("transaction_type").isin("wire", "ach")),
        ),
        ("impossible_travel", has_travel),
    ]


def _weights_map(rows=FRAUD_SIGNATURE_ROWS) -> Column:
    pairs = []
    for _, sig_type, _, weight in rows:
        pairs += [F.lit(sig_type), F.lit(float(weight))]
    return F.create_map(*pairs)


def default_score(activity: DataFrame, travel: DataFrame | None = None) -> DataFrame:
    """Adds risk_score, risk_level, reason, matched_signatures to each activity row.

    matched_signatures: signature types whose rule holds. risk_score = max(base, 100 × the largest
    matched signature weight), rounded to 2, where base = 30·high-value wire + 15·recent IP change
    + 5·MFA flag. Level from the score bands. Everything is a row-local expression except the
    optional travel membership: a ``has_travel_flag`` column when the activity carries one
    (``silver.user_activity(..., with_travel=True)``, no extra shuffle),
    else a join with the distinct flagged users.
    """
    df = activity
    has_travel = F.lit(False)
    if "has_travel_flag" in activity.columns:
        has_travel = _true("has_travel_flag")
    elif travel is not None:
        users = travel.select("user_id").where(F.col("user_id").isNotNull()).distinct()
        df = df.join(users.withColumn("__travel", F.lit(True)), "user_id", "left")
        has_travel = _true("__travel")
    rules = _signature_rules(has_travel)
    matched = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]), lambda x: x.isNotNull())
    weights = _weights_map()
    max_weight = F.array_max(F.transform(F.col("matched_signatures"), lambda t: F.element_at(weights, t)))
    base = (
        F.when(_true("high_value_wire"), 30.0).otherwise(0.0)
        + F.when(_true("ip_changed_recently"), 15.0).otherwise(0.0)
        + F.when(_true("mfa_change_flag"), 5.0).otherwise(0.0)
    )
    reason = F.concat_ws(
        " ",
        F.when(
            F.size("matched_signatures") > 0,
            F.concat(F.lit("Matched signatures: "), F.array_join("matched_signatures", ", "), F.lit(".")),
        ),
        F.when(_true("high_value_wire"), F.lit("High-value wire.")),
        F.when(_true("ip_changed_recently"), F.lit("New IP within the last hour.")),
        F.when(_true("mfa_change_flag"), F.lit("Recent MFA change.")),
    )
    out = (
        df.withColumn("matched_signatures", matched)
        .withColumn("risk_score", F.round(F.greatest(base, F.coalesce(max_weight, F.lit(0.0)) * 100.0), 2))
        .withColumn("risk_level", risk_level("risk_score"))
        .withColumn("reason", F.coalesce(F.nullif(reason, F.lit("")), F.lit("No risk signals.")))
    )
    return out.select(*activity.columns, "risk_score", "risk_level", "reason", "matched_signatures")


# ---- replies of an external scorer ----------------------------------------------------------------

_REPLY_JSON = StructType(
    [
        StructField("risk_score", StringType()),
        StructField("risk_level", StringType()),
        StructField("reason", StringType()),
        StructField("matched_signatures", StringType()),  # JSON text: its type does not matter to the rest
        StructField("_corrupt", StringType()),
    ]
)
# Strict JSON: no single quotes, malformed input recorded instead of half-parsed.
_JSON_OPTIONS = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}


def _strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` removes only spaces)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def strip_fence(reply: Column) -> Column:
    """Strip whitespace; if the reply starts with a Markdown fence keep the text after it (up to
    the next fence) and drop a ``json`` tag at its start."""
    t = _strip(reply)
    inner = F.split(t, "```", -1).getItem(1)
    untagged = F.when(inner.startswith("json"), inner.substr(F.lit(5), F.lit(1 << 30))).otherwise(inner)
    return F.when(t.startswith("```"), untagged).otherwise(t)


def parse_reply(df: DataFrame, reply_col: str = "reply") -> DataFrame:
    """Parse a JSON reply into risk_score (double), risk_level, reason, matched_signatures and
    ``parse_error`` (NULL when the reply is usable).

    Unusable: no reply, a reply that is not a JSON object, or a risk_score that is null or not a number.
    matched_signatures that are not a list are NULL and do not matter to the rest.
    An object without a risk_score scores 0 (as the source's default), and numeric strings are
    accepted. The level is not validated here (see ``quality``)."""
    text = strip_fence(F.col(reply_col))
    parsed = F.from_json(text, _REPLY_JSON, _JSON_OPTIONS)
    raw_score = parsed.getField("risk_score")
    score = raw_score.try_cast("double")
    # One JSON object and nothing after it (a JSON parser rejects trailing text).
    is_object = (
        F.json_object_keys(text).isNotNull()
        & parsed.getField("_corrupt").isNull()
        & _strip(text).endswith("}")
    )
    error = (
        F.when(F.coalesce(_strip(F.col(reply_col)), F.lit("")) == "", F.lit("empty reply"))
        .when(
            ~F.coalesce(is_object, F.lit(False)),
            F.concat(F.lit("unparseable reply ("), F.length(F.col(reply_col)).cast("string"), F.lit(" chars)")),
        )
        .when(raw_score.isNotNull() & score.isNull(), F.concat(F.lit("invalid risk_score: "), raw_score))
        .when(raw_score.isNull() & F.array_contains(F.json_object_keys(text), "risk_score"), F.lit("invalid risk_score: null"))
    )
    return df.select(
        "*",
        F.coalesce(score, F.lit(0.0)).alias("risk_score"),
        parsed.getField("risk_level").alias("risk_level"),
        parsed.getField("reason").alias("reason"),
        F.from_json(parsed.getField("matched_signatures"), ArrayType(StringType())).alias("matched_signatures"),
        error.alias("parse_error"),
    )


def render_reply(scored: DataFrame, fence_col: Column | None = None) -> Column:
    """The JSON reply a scorer would send for already-scored rows (optionally Markdown-fenced)."""
    body = F.to_json(F.struct("risk_score", "risk_level", "reason", "matched_signatures"))
    if fence_col is None:
        return body
    return F.when(fence_col == "json", F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(
        fence_col == "plain", F.concat(F.lit("```\n"), body, F.lit("\n```"))
    ).otherwise(body)


def with_action_and_fallback(parsed: DataFrame, error_prefix: str = "") -> DataFrame:
    """Apply the ladder; rows with a parse error take the fallback (0, LOW, MONITOR, error text).

    The level written is the scorer's level, defaulting to LOW when missing; the ladder sees an
    empty level in that case, as in the source pipeline. The operational store prefixes the error
    text with ``Error: `` (``error_prefix=OPERATIONAL_ERROR_PREFIX``); the gold table keeps it bare.
    """
    err = F.col("parse_error").isNotNull()
    level_for_ladder = F.coalesce(F.col("risk_level"), F.lit(""))
    return (
        parsed.withColumn("automated_action", F.when(err, F.lit(FALLBACK_ACTION)).otherwise(risk_action(level_for_ladder, F.coalesce(F.col("risk_score"), F.lit(0.0)))))
        .withColumn("risk_score", F.when(err, F.lit(FALLBACK_SCORE)).otherwise(F.coalesce(F.col("risk_score"), F.lit(0.0))))
        .withColumn("risk_level", F.when(err, F.lit(FALLBACK_LEVEL)).otherwise(F.coalesce(F.col("risk_level"), F.lit(FALLBACK_LEVEL))))
        .withColumn(
            "reason",
            F.when(err, F.concat(F.lit(error_prefix), F.col("parse_error"))).otherwise(F.coalesce(F.col("reason"), F.lit(""))),
        )
    )


def prompt_text(summary, hits_json) -> Column:
    """The text for an external scorer: the summary and the similar signatures (JSON)."""
    return F.concat(
        F.lit(PROMPT_TRANSACTION_HEADER),
        _c(summary),
        F.lit(PROMPT_SIGNATURES_HEADER),
        F.coalesce(_c(hits_json), F.lit("[]")),
        F.lit(PROMPT_FOOTER),
    )


ExternalScorer = Callable[[pd.DataFrame], pd.Series]


def score_external(activity: DataFrame, scorer: ExternalScorer, hits: DataFrame | None = None) -> DataFrame:
    """Score with an external function of a pandas batch (columns transaction_id, summary, hits,
    signatures_searched, prompt) returning one reply string per row. Runs per Arrow batch on the
    executors via ``mapInPandas``; a row that raises gets the error text as its reply (→ a
    fallback row); the other rows of its batch are scored. ``hits``: ``similarity.collect_hits`` output keyed by transaction_id.
    The result keeps ``transaction_query_text`` and ``signatures_searched`` as in the source."""
    q = activity.select("transaction_id", summary_text().alias("summary"))
    if hits is not None:
        q = q.join(
            hits.select("transaction_id", F.to_json("hits").alias("hits"), "signatures_searched"), "transaction_id", "left"
        ).withColumn("signatures_searched", F.coalesce(F.col("signatures_searched"), F.lit(0)))
    else:
        q = q.withColumns({"hits": F.lit(None).cast("string"), "signatures_searched": F.lit(0)})
    q = q.withColumn("prompt", prompt_text("summary", "hits"))

    def ask(pdf: pd.DataFrame) -> tuple[list, list]:
        """(replies, errors): a batch that raises is halved, down to the rows that raise alone."""
        try:
            return list(pd.Series(scorer(pdf), index=pdf.index).astype("object")), [None] * len(pdf)
        except Exception as e:  # noqa: BLE001 - the error text becomes the fallback reason
            if len(pdf) < 2:
                return [None] * len(pdf), [str(e)] * len(pdf)
        half = len(pdf) // 2
        first, second = ask(pdf.iloc[:half]), ask(pdf.iloc[half:])
        return first[0] + second[0], first[1] + second[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies, errors = ask(pdf)
            done = pdf.assign(reply=pd.Series(replies, index=pdf.index, dtype="object"), error=pd.Series(errors, index=pdf.index, dtype="object"))
            yield done[["transaction_id", "summary", "signatures_searched", "reply", "error"]]

    replies = q.mapInPandas(
        run, "transaction_id string, summary string, signatures_searched int, reply string, error string"
    )
    parsed = parse_reply(replies, "reply").withColumn(
        "parse_error", F.coalesce(F.col("error"), F.col("parse_error"))
    ).drop("error")
    return parsed.withColumnRenamed("summary", "transaction_query_text")

