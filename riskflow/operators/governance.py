"""Column tags and masking by principal group.

Tags live in the column metadata (``{"tags": {"sensitivity": "pii"}}``); a policy maps a tag value
to the groups allowed to see clear values. Masking is a row-local expression, so it costs nothing
beyond the projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = "****"
TAG_KEY = "sensitivity"


def tag_columns(df: DataFrame, tags: Mapping[str, str], key: str = TAG_KEY) -> DataFrame:
    """Attach ``{key: value}`` tags to columns (kept in the schema metadata, also when written)."""
    for col, value in tags.items():
        meta = dict(df.schema[col].metadata)
        meta.setdefault("tags", {})
        meta["tags"] = {**meta["tags"], key: value}
        df = df.withMetadata(col, meta)
    return df


def column_tags(df: DataFrame, key: str = TAG_KEY) -> dict[str, str]:
    return {f.name: f.metadata["tags"][key] for f in df.schema.fields if key in f.metadata.get("tags", {})}


def mask_value(col: Column, allowed: bool) -> Column:
    """The value when the viewer is allowed, else ``****`` (NULL stays NULL)."""
    if allowed:
        return col
    return F.when(col.isNotNull(), F.lit(MASK))


def mask_columns(
    df: DataFrame,
    policy: Mapping[str, Iterable[str]],
    viewer_groups: Iterable[str],
    key: str = TAG_KEY,
) -> DataFrame:
    """Mask every tagged column whose tag's allowed groups do not meet ``viewer_groups``.

    ``policy``: tag value → groups allowed to see clear values. Masked columns become strings.
    """
    groups = set(viewer_groups)
    tags = column_tags(df, key)
    out = []
    for name in df.columns:
        tag = tags.get(name)
        if tag is None or groups & set(policy.get(tag, ())):
            out.append(F.col(name))
        else:
            out.append(mask_value(F.col(name).cast("string"), False).alias(name))
    return df.select(*out)


def register_mask_function(spark: SparkSession, allowed_groups: Iterable[str], viewer_groups: Iterable[str]) -> None:
    """SQL ``mask_card(col)``: the value for allowed viewers, else ``****`` (group membership is
    resolved when the function is registered)."""
    allowed = bool(set(allowed_groups) & set(viewer_groups))
    body = "col" if allowed else f"CASE WHEN col IS NULL THEN NULL ELSE '{MASK}' END"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION mask_card(col STRING) RETURNS STRING RETURN {body}")
