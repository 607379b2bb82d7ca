"""The drug/illness dimension.

The dimension is configuration (tens of rows, edited by hand), so it lives
on the driver as a list of :class:`IllnessSpec` and is turned into a small
DataFrame where a join needs it. Its size is checked before it is broadcast.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxatlas.operators.drug_list import DEFAULT_ILLNESSES
from rxatlas.schemas import ILLNESS_DIM

MAX_BROADCAST_DIMENSION_ROWS = 200_000


@dataclass(frozen=True)
class IllnessSpec:
    illness: str
    tags: tuple
    medications: tuple

    @property
    def column(self) -> str:
        return column_name(self.illness)

    def pattern(self) -> str:
        """Case-blind alternation of the medication names, quoted."""
        return "|".join(_quote(m) for m in self.medications)


def title(s: str) -> str:
    """V4 on the driver (Python title case)."""
    return s.title()


def column_name(illness: str) -> str:
    """Illness -> column name: lower case, blanks to underscores."""
    return re.sub(r"\s+", "_", illness.strip().lower())


_META = re.compile(r"([.^$*+?()\[\]{}|\\])")


def _quote(name: str) -> str:
    return _META.sub(r"\\\1", name)


def normalise_spec(rows, trim: bool = True) -> list[IllnessSpec]:
    """Title-case illness, tags and names as the dimension's loader does;
    drop blanks around names (D11)."""
    out = []
    for illness, tags, meds in rows:
        names = tuple(title(m.strip() if trim else m) for m in meds)
        out.append(IllnessSpec(title(illness), tuple(title(t) for t in tags), names))
    return out


def default_spec() -> list[IllnessSpec]:
    return normalise_spec(DEFAULT_ILLNESSES)


def load_spec_yaml(path: str) -> list[IllnessSpec]:
    """Read a drugs list YAML (illness -> {illness, tags, medications})."""
    import yaml
    with open(path, encoding="utf-8-sig") as fh:
        doc = yaml.safe_load(fh) or {}
    rows = [(v["illness"], v.get("tags") or [], [m["name"] for m in v.get("medications") or []])
            for v in doc.values()]
    return normalise_spec(rows)


def save_spec_yaml(spec: list[IllnessSpec], path: str) -> None:
    """K7: write the dimension back in the same layout."""
    import yaml
    doc = {s.illness: {"illness": s.illness, "tags": list(s.tags),
                       "medications": [{"name": m} for m in s.medications]} for s in spec}
    with open(path, "w", encoding="utf-8") as fh:
        yaml.safe_dump(doc, fh, sort_keys=False, allow_unicode=True)


def save_dimension(dim: DataFrame, path: str) -> None:
    """K7 as data: the nested dimension, one JSON row an illness, on any file system."""
    dim.select("illness", "tags", "medications").repartitionByRange(1, "illness").write.mode("overwrite").json(path)


def load_dimension(spark: SparkSession, path: str) -> DataFrame:
    """S11 as data: the dimension that :func:`save_dimension` wrote."""
    return spark.read.schema(ILLNESS_DIM).json(path)


def read_flat_csv(spark: SparkSession, path: str, trim: bool = True) -> DataFrame:
    """Headerless ``illness,drug`` CSV (BOM stripped by the reader)."""
    df = spark.read.schema("illness string, drug string").option("header", False).csv(path)
    drug = F.trim("drug") if trim else F.col("drug")
    return df.select(F.initcap("illness").alias("illness"), F.initcap(drug).alias("medication"))


def dimension_df(spark: SparkSession, spec: list[IllnessSpec]) -> DataFrame:
    """T9 nested rows from the driver-side spec."""
    return spark.createDataFrame(
        [(s.illness, list(s.tags), [(m,) for m in s.medications]) for s in spec], ILLNESS_DIM)


def flat_dimension(dim: DataFrame) -> DataFrame:
    """One row per (illness, medication), tags kept as an array."""
    return dim.select("illness", "tags", F.explode("medications.name").alias("medication"))


def check_broadcastable(df: DataFrame, limit: int = MAX_BROADCAST_DIMENSION_ROWS) -> DataFrame:
    """Broadcast a dimension only behind a size check; larger ones join normally."""
    n = df.count()
    return F.broadcast(df) if n <= limit else df


def select_illnesses(dim: DataFrame, tag: str | None = None, illness: str | None = None) -> DataFrame:
    """V5 + F9: filter the dimension by tag or illness (exclusive; neither = all)."""
    if tag is not None and illness is not None:
        raise ValueError("choose by tag or by illness, not both")
    if tag is not None:
        return dim.filter(F.array_contains("tags", title(tag)))
    if illness is not None:
        sel = dim.filter(F.col("illness") == title(illness))
        return sel
    return dim


def medications(dim: DataFrame, tag: str | None = None, illness: str | None = None,
                check_known: bool = True) -> DataFrame:
    """The distinct medicine names for a tag, an illness, or all.

    An unknown illness is an error, as a lookup by key is in the reference;
    the check is one tiny aggregate over the dimension.
    """
    sel = select_illnesses(dim, tag, illness)
    if illness is not None and check_known and sel.limit(1).count() == 0:
        raise KeyError(f"unknown illness {illness!r}")
    return flat_dimension(sel).select("medication").distinct()


def all_tags(dim: DataFrame) -> DataFrame:
    """Distinct tags."""
    return dim.select(F.explode("tags").alias("tag")).distinct()


def all_illnesses(dim: DataFrame) -> DataFrame:
    """Distinct illnesses."""
    return dim.select("illness").distinct()


def spec_by_tag(spec: list[IllnessSpec], tag: str) -> list[IllnessSpec]:
    """F8 on the driver-side spec: illnesses carrying ``tag``."""
    t = title(tag)
    return [s for s in spec if t in s.tags]


def spec_by_names(spec: list[IllnessSpec], names) -> list[IllnessSpec]:
    wanted = {column_name(n) for n in names}
    out = [s for s in spec if s.column in wanted]
    if len(out) != len(wanted):
        raise KeyError(f"unknown illnesses {sorted(wanted - {s.column for s in out})}")
    return out


def illness_item_columns(spec: list[IllnessSpec], description: str = "BNF_DESCRIPTION",
                         items: str = "ITEMS") -> list[Column]:
    """P9 (regex mode): per illness, ITEMS when the description matches any of
    its names case-blind, else 0. One pass computes every illness; a row can
    count for several illnesses (D10)."""
    d, it = F.col(description), F.col(items)
    low = F.lower(d)
    out = []
    for s in spec:
        if all(m.isascii() for m in s.medications):
            # literal names, ASCII case folding: a substring test on the
            # lower-cased text equals the case-blind regex and skips the
            # regex engine (one lower() per row shared by every illness)
            hit = F.lit(False)
            for m in s.medications:
                hit = hit | low.contains(m.lower())
        else:
            hit = d.rlike("(?i)" + s.pattern())
        out.append(F.when(hit, it).otherwise(F.lit(0).cast("bigint")).alias(s.column))
    return out


#: Names from which one pass with an automaton beats a substring test a name.
MANY_NAMES = 64


def matched_illnesses(text: Column, spec: list[IllnessSpec]) -> Column:
    """P9 over any number of names: array<int> of the illnesses (by number in
    ``spec``) one of whose names ``text`` (lower case) holds.

    All names are one Aho-Corasick automaton, so a text is read once however many
    names there are. It is built on the driver from the spec, which is
    configuration, and goes to each worker once with the function; a batch's
    repeated texts are matched once.
    """
    import ahocorasick
    names: dict[str, set[int]] = {}
    for k, s in enumerate(spec):
        for m in s.medications:
            names.setdefault(m.lower(), set()).add(k)
    always = sorted(names.pop("", set()))  # every text holds the empty name
    automaton = ahocorasick.Automaton()
    for m, ks in names.items():
        automaton.add_word(m, tuple(sorted(ks)))
    automaton.make_automaton()

    def one(t) -> list[int] | None:
        if t is None:
            return None
        found = set(always)
        if names:
            for _, ks in automaton.iter(t):
                found.update(ks)
        return sorted(found)

    @F.pandas_udf("array<int>")
    def match(texts: pd.Series) -> pd.Series:
        code, unique = pd.factorize(texts)
        hits = [one(t) for t in unique]
        return pd.Series([hits[c] if c >= 0 else None for c in code], dtype=object)

    return match(text)


def flag_items_automaton(epd: DataFrame, spec: list[IllnessSpec], description: str = "BNF_DESCRIPTION",
                         items: str = "ITEMS") -> DataFrame:
    """P9 (regex mode) like :func:`illness_item_columns`, for long lists of
    names: ``epd`` with a column of items per illness. Illnesses with a name
    beyond ASCII keep the regex, whose case folding is its own."""
    plain = [s for s in spec if all(m.isascii() for m in s.medications)]
    d, it, none = F.col(description), F.col(items), F.lit(0).cast("bigint")
    number = {s.illness: k for k, s in enumerate(plain)}
    rows = epd.withColumn("_matched", matched_illnesses(F.lower(d), plain))
    hit = lambda s: F.array_contains("_matched", number[s.illness]) if s.illness in number else d.rlike("(?i)" + s.pattern())
    return rows.select(*epd.columns, *[F.when(hit(s), it).otherwise(none).alias(s.column) for s in spec])


def flag_items_exact(epd: DataFrame, dim: DataFrame, spec: list[IllnessSpec],
                     medication: str = "CHEMICAL_SUBSTANCE_BNF_DESCR",
                     items: str = "ITEMS") -> DataFrame:
    """P9 (exact mode, D11): per illness, ITEMS when the medication equals one
    of its names. The dimension is folded to one row per medication first, so
    the join cannot duplicate prescription rows."""
    per_med = (flat_dimension(dim).groupBy("medication")
               .agg(F.collect_set("illness").alias("_ill")))
    j = epd.join(check_broadcastable(per_med), epd[medication] == per_med["medication"], "left")
    cols = [F.when(F.array_contains(F.col("_ill"), s.illness), F.col(items))
            .otherwise(F.lit(0).cast("bigint")).alias(s.column) for s in spec]
    return j.select(*[epd[c] for c in epd.columns], *cols)


def illness_totals(flagged: DataFrame, spec: list[IllnessSpec]) -> DataFrame:
    """Total detected items per illness (long format)."""
    sums = flagged.agg(*[F.sum(s.column).alias(s.column) for s in spec])
    return sums.select(F.explode(F.array(*[
        F.struct(F.lit(s.illness).alias("illness"), F.col(s.column).alias("items"))
        for s in spec])).alias("r")).select("r.*")


def medication_totals(grouped: DataFrame, dim: DataFrame, tag: str | None = None,
                      illness: str | None = None, year: int | None = None) -> DataFrame:
    """S8 + F7: items per year and medication for the selected medicines; a
    given year is a partition filter on the base table.

    The medicine list is a semi-join (broadcast behind a size check), so on a
    partitioned base table it also drives dynamic partition pruning."""
    meds = medications(dim, tag, illness)
    g = grouped if year is None else grouped.filter(F.col("year") == year)
    sel = g.join(check_broadcastable(meds), "medication", "left_semi")
    return sel.groupBy("year", "medication").agg(F.sum("total_items").alias("total_items"))


def illness_medication_totals(grouped: DataFrame, dim: DataFrame) -> DataFrame:
    """Items per illness and year over the illness's medicines (a
    medicine shared by two illnesses counts for both)."""
    flat = flat_dimension(dim).select("illness", "medication").distinct()
    j = grouped.join(check_broadcastable(flat), "medication")
    return j.groupBy("illness", "year").agg(F.sum("total_items").alias("total_items"),
                                           F.countDistinct("medication").alias("n_medications"))
