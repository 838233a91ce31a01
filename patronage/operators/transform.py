"""Per-source transformation after cleaning.

Sources are offset so transaction ids from different sources never collide:
each source's numeric ids are shifted by (previous source's max id + 1000).
The offsets are lazy scalar subqueries, so the three sources still form one
plan; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import first_digit_run, hash_pick, hash_range
from .cleaning import SourceSpec
from .keys import with_sequential_id

# Fixed label set of the product categoriser.
CANDIDATE_LABELS = (
    "Beauty", "Clothing", "Electronics", "Home Decor",
    "Kitchenware", "Toys", "Books", "Office Supplies",
)
FALLBACK_LABEL = "Other"

# Default keyword rules (ours): label -> words matched as whole words in the
# lower-cased product name; first label with a hit wins.
DEFAULT_KEYWORDS = {
    "Beauty": ("lipstick", "perfume", "cream", "lotion", "soap", "shampoo", "makeup", "ring", "necklace"),
    "Clothing": ("shirt", "dress", "jacket", "sock", "socks", "hat", "scarf", "shoe", "shoes", "coat"),
    "Electronics": ("gizmo", "gadget", "phone", "cable", "charger", "battery", "radio", "gear"),
    "Home Decor": ("frame", "candle", "vase", "ornament", "cushion", "clock", "lantern", "heart"),
    "Kitchenware": ("plate", "mug", "cup", "bowl", "spoon", "teapot", "jar", "tin", "glass"),
    "Toys": ("toy", "doll", "game", "puzzle", "ball", "widget", "kite"),
    "Books": ("book", "notebook", "journal", "diary", "novel"),
    "Office Supplies": ("pen", "pencil", "paper", "stapler", "bolt", "rod", "anvil"),
}

GENDER_CHOICES = ("Male", "Female")
TRANSFORM_AGE = (18, 75)


def keyword_category(name: str | Column, keywords: dict[str, Sequence[str]] = DEFAULT_KEYWORDS,
                     fallback: str = FALLBACK_LABEL) -> Column:
    """M24 default classifier as one CASE expression (codegen, no Python)."""
    text = F.lower(F.col(name) if isinstance(name, str) else name)
    out = None
    for label in CANDIDATE_LABELS:
        words = keywords.get(label)
        if not words:
            continue
        cond = text.rlike(r"\b(" + "|".join(words) + r")\b")
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(fallback)) if out is not None else F.lit(fallback)


def categorize(df: DataFrame, name: str = "product_name", out: str = "category",
               classifier: Callable[[pd.Series], pd.Series] | None = None, failed: str | None = None) -> DataFrame:
    """Product name -> one of ``CANDIDATE_LABELS`` (else 'Other').

    Default: keyword expression evaluated per row (cheaper than a shuffle).
    With ``classifier`` (a vectorised pandas function, e.g. a model), it is
    applied once per *distinct* name through a pandas UDF and joined back;
    Spark picks broadcast or shuffle join from the measured size of the
    distinct-name table.  Failures and unknown names become 'Other'.  A name
    whose batch fails is tried again alone, so an exception costs only the
    names that raise it; ``failed`` names a boolean column that marks their rows.
    """
    if classifier is None:
        out_df = df.withColumn(out, F.when(F.col(name).isNull(), F.lit(FALLBACK_LABEL))
                               .otherwise(keyword_category(name)))
        return out_df.withColumn(failed, F.lit(False)) if failed else out_df

    @F.pandas_udf("label string, failed boolean")
    def classify(names: pd.Series) -> pd.DataFrame:
        def tried(part: pd.Series) -> pd.Series | None:
            try:
                return pd.Series(list(classifier(part)), index=part.index, dtype="object")
            except Exception:  # noqa: BLE001 - reported per row
                return None

        labels = tried(names)
        if labels is None:
            single = [tried(names.iloc[i:i + 1]) for i in range(len(names))]
            labels = pd.Series([None if x is None else x.iloc[0] for x in single], index=names.index, dtype="object")
            bad = pd.Series([x is None for x in single], index=names.index)
        else:
            bad = pd.Series(False, index=names.index)
        return pd.DataFrame({"label": labels.where(labels.isin(CANDIDATE_LABELS), FALLBACK_LABEL), "failed": bad})

    mapping = (df.select(name).where(F.col(name).isNotNull()).distinct()
                 .withColumn("_found", classify(F.col(name))))
    joined = df.join(mapping, name, "left").withColumn(out, F.coalesce("_found.label", F.lit(FALLBACK_LABEL)))
    if failed:
        joined = joined.withColumn(failed, F.coalesce("_found.failed", F.lit(False)))
    return joined.drop("_found")


def fill_demographics(df: DataFrame, customer: str = "customer_id", age_range=TRANSFORM_AGE) -> DataFrame:
    """P21/P22 (J01 as an expression): deterministic per-customer gender and
    age, used where absent, NULL, 'Unknown' (gender) or 0 (age)."""
    fake_gender = hash_pick(customer, GENDER_CHOICES, salt="gender:")
    fake_age = hash_range(customer, age_range[0], age_range[1], salt="age:")
    if "gender" in df.columns:
        df = df.withColumn("gender", F.when(F.col("gender").isNull() | (F.col("gender") == "Unknown"),
                                            fake_gender).otherwise(F.col("gender")))
    else:
        df = df.withColumn("gender", fake_gender)
    if "age" in df.columns:
        age = F.coalesce(F.col("age").cast("double"), F.lit(0.0))
        df = df.withColumn("age", F.when(age == 0, fake_age.cast("double")).otherwise(age))
    else:
        df = df.withColumn("age", fake_age.cast("double"))
    return df


def numeric_max(df: DataFrame, c: str = "transaction_id") -> Column:
    return df.select(F.max(F.col(c).cast("string").try_cast("bigint"))).scalar()


def offset_ids(df: DataFrame, offset: Column | int, c: str = "transaction_id",
               collapse_text: bool = False) -> DataFrame:
    """P20: numeric ids + offset.  Text ids (cancelled 'C…' invoices) are kept
    as they are, or with ``collapse_text`` become 0 + offset like the source."""
    off = offset if isinstance(offset, Column) else F.lit(offset)
    num = F.col(c).cast("string").try_cast("bigint")
    if collapse_text:
        new = (F.coalesce(num, F.lit(0)) + off).cast("string")
    else:
        new = F.when(num.isNotNull(), (num + off).cast("string")).otherwise(F.col(c).cast("string"))
    return df.withColumn(c, new)


def ensure_ids(df: DataFrame, offset: int = 0, c: str = "transaction_id",
               order: Sequence[str] | None = None) -> DataFrame:
    """Generate sequential ids when the source has none (scalable keys)."""
    if c in df.columns:
        return df
    keyed = with_sequential_id(df, list(order or df.columns), name=c, start=offset + 1)
    return keyed.withColumn(c, F.col(c).cast("string"))


def transform_retail(clean: DataFrame, offset: Column | int | None = None, source: str = "Kaggle") -> DataFrame:
    df = ensure_ids(clean)
    if offset is not None:
        df = offset_ids(df, offset)
    df = df.withColumn("customer_id", first_digit_run("customer_id"))  # P16
    df = df.drop("total_amount", "product_name")                       # P17
    df = fill_demographics(df)
    return df.withColumn("source", F.lit(source))                      # P18


def transform_online(clean: DataFrame, offset: Column | int, source: str = "UCI",
                     collapse_text: bool = False, classifier=None) -> DataFrame:
    df = ensure_ids(clean)
    df = offset_ids(df, offset, collapse_text=collapse_text)
    df = df.withColumn("customer_id", first_digit_run("customer_id"))
    df = fill_demographics(df)
    if "product_name" not in df.columns and "description" in df.columns:
        df = df.withColumnRenamed("description", "product_name")
    df = categorize(df, classifier=classifier).drop("product_name")
    return df.withColumn("source", F.lit(source))


def transform_orders(clean: DataFrame, offset: Column | int, source: str = "ORD",
                     classifier=None) -> DataFrame:
    return transform_online(clean.drop("sku_code"), offset, source, classifier=classifier)


def kind_of(spec: SourceSpec, clean: DataFrame) -> str:
    """How a source is transformed: as declared, else by its columns."""
    if spec.kind != "auto":
        return spec.kind
    named = {"product_name", "description"} & set(clean.columns)
    return "online" if named and "category" not in clean.columns else "retail"


def transform_sources(cleaned: Sequence[tuple[SourceSpec, DataFrame]], gap: int = 1000,
                      classifier=None) -> list[DataFrame]:
    """Every source given, in order of rank, whatever its name; the numeric ids
    of each are shifted past those of the sources before it."""
    out: list[DataFrame] = []
    running: Column = F.lit(0).cast("bigint")
    for spec, clean in sorted(cleaned, key=lambda x: x[0].rank):
        kind = kind_of(spec, clean)
        if kind == "retail":
            df = transform_retail(clean, running + gap if out else None, spec.name)
        elif kind in ("online", "orders"):
            step = transform_online if kind == "online" else transform_orders
            df = step(clean, running + gap, spec.name, classifier=classifier)
        else:
            raise ValueError(f"source {spec.name}: unknown kind {spec.kind!r}")
        out.append(df)
        running = F.coalesce(numeric_max(df), running)
    return out
