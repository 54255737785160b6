"""Feature plan: raw accident tables -> one wide row per road user.

The full-width join tree (users, vehicles, accidents, places) stands once in
the plan. Group features come from the users and their vehicles alone: distinct
counts don't change under the later joins, and class counts are multiplied by
the number of accident and place rows that an accident is joined to. Medians
count the values of the clipped columns over the same joins reduced to them
(their domains are bounded by the clips).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadframe import rules as R
from roadframe.functions.cleaning import (
    clip, hour_from_hhmm, nonzero_flag, safe_date, strip_to_long, weekday_name,
)
from roadframe.functions.flags import flag_columns
from roadframe.functions.recode import collapse_target, recode_columns
from roadframe.operators.group import group_table, join_group_table
from roadframe.operators.relate import drop_duplicate_rows, left_join, lookup_join
from roadframe.operators.schema import drop_if_present, rename_if_present
from roadframe.operators.stats import medians_by_value
from roadframe.session import limit_generated_code, share_partitions


@dataclass
class AccidentConfig:
    """Parameters of the ETL; defaults reproduce the original data set."""
    years: list[int] = field(default_factory=lambda: list(R.YEARS_TO_PROCESS))
    oldest_year: int = R.OLDEST_YEAR
    vma_cap: int = R.VMA_CAP
    recode_rules: dict = field(default_factory=lambda: R.RECODE_RULES)
    features_to_drop: dict = field(default_factory=lambda: R.FEATURES_TO_DROP)
    secu_flags: dict = field(default_factory=lambda: R.SECU_FLAGS)
    choc_flags: dict = field(default_factory=lambda: R.CHOC_FLAGS)
    vehicle_classes: list = field(default_factory=lambda: list(R.VEHICLE_CLASSES))
    # compat=True reproduces the original values (see README "Semantic choices")
    compat: bool = True
    accident_key: str = "Num_Acc"
    vehicle_key: str = "id_vehicule"
    user_key: str = "id_usager"
    dedup: bool = True
    # match NULL join keys with each other, as a pandas merge does (n x m rows)
    match_null_keys: bool = False


def preprocess(df: DataFrame, prefix: str, cfg: AccidentConfig) -> DataFrame:
    """Drop the prefix's unused columns and unify the accident key name."""
    df = drop_if_present(df, cfg.features_to_drop.get(prefix, []))
    if prefix == "caracteristiques":
        df = rename_if_present(df, {"Accident_Id": cfg.accident_key})
    return df


def join_tables(usagers: DataFrame, vehicules: DataFrame, caracteristiques: DataFrame,
                lieux: DataFrame, cfg: AccidentConfig) -> DataFrame:
    """users ⟕ vehicles (2 keys) ⟕ accidents ⟕ places, all left joins.

    The users are shuffled once, by accident, and sorted once, by accident and vehicle, for all joins.
    """
    k, v = cfg.accident_key, cfg.vehicle_key
    ns = cfg.match_null_keys
    df = left_join(usagers.repartition(k), vehicules, [k, v], null_safe=ns)
    df = left_join(df, caracteristiques, [k], null_safe=ns)
    df = left_join(df, lieux, [k], null_safe=ns)
    return df


def accident_features(usagers: DataFrame, vehicules: DataFrame, caracteristiques: DataFrame,
                      lieux: DataFrame, cfg: AccidentConfig) -> DataFrame:
    """Per accident: distinct vehicles and users, and of each vehicle class the user rows after all joins.

    Without ``compat``, of each class the distinct vehicles (G13): occupants of one vehicle are one, and
    repeated accident and place rows count nothing.
    """
    k, v, u = cfg.accident_key, cfg.vehicle_key, cfg.user_key
    users = usagers.select(*[c for c in (k, v, u) if c in usagers.columns]).filter(F.col(k).isNotNull())
    has_class = "catv" in vehicules.columns
    rows = left_join(users.select(k, v).repartition(k), vehicules.select(k, v, *(["catv"] if has_class else [])), [k, v], null_safe=cfg.match_null_keys)
    if has_class:
        rows = recode_columns(rows, {c: r for c, r in cfg.recode_rules.items() if c == "catv"})
    rows = rows.withColumn(v, strip_to_long(v, rows.schema[v].dataType))
    classes = cfg.vehicle_classes if has_class else []
    if not cfg.compat and classes:
        table = group_table(rows, k, {"nb_v": v})
        of_class = group_table(rows.filter(F.col(v).isNotNull()).select(k, v, "catv").distinct(), k, None, "catv", classes)
        table = table.join(of_class, on=k, how="left").fillna(0, [f"count_{x}" for x in classes])
    else:
        table, times = group_table(rows, k, {"nb_v": v}, "catv", classes), F.lit(1)
        for i, other in enumerate((caracteristiques, lieux)):  # every row of the accident there repeats its users
            table = table.join(other.groupBy(k).agg(F.count(F.lit(1)).alias(f"__rows_{i}")), on=k, how="left")
            times = times * F.coalesce(F.col(f"__rows_{i}"), F.lit(1))
        table = table.withColumns({f"count_{x}": F.col(f"count_{x}") * times for x in classes})
    if u in users.columns:  # counted by itself: two distinct counts at once would send every row three times
        table = table.join(group_table(users.select(k, u).repartition(k), k, {"nb_u": u}), on=k, how="left")
    return table.select(k, *[c for c in ("nb_v", "nb_u") if c in table.columns], *[f"count_{x}" for x in classes])


def engineer_features(df: DataFrame, regions: DataFrame | None, cfg: AccidentConfig,
                      lookup_key: str = "departement", lookup_value: str = "region",
                      per_accident: DataFrame | None = None) -> DataFrame:
    """Recode, group features, cleaning, dates, lookup, target — one user row in, one out."""
    k, v, u = cfg.accident_key, cfg.vehicle_key, cfg.user_key
    last, first = cfg.years[-1], cfg.years[0]
    for c in ("an", "mois", "jour"):
        if c not in df.columns:
            raise ValueError(f"missing date column {c!r}")
    clipped = {"an": clip("an", first, last), "mois": clip("mois", 1, 12), "jour": clip("jour", 1, 31)}
    if "an_nais" in df.columns:
        clipped["an_nais"] = clip("an_nais", cfg.oldest_year, last)
    # Medians of the clipped columns over the joined rows. Computed here, on a
    # plan that only carries the join keys and these columns (Catalyst prunes
    # the rest before every shuffle), and before the group-feature aggregate,
    # which is 1:1 and does not change them.
    src = {"jour": "mois"} if cfg.compat else {}
    need = sorted({src.get(c, c) for c in clipped})
    med = medians_by_value(df.select(*[clipped[c].alias(c) for c in need]), need)

    df = recode_columns(df, cfg.recode_rules)
    if v in df.columns:
        df = df.withColumn(v, strip_to_long(v, df.schema[v].dataType))
    classes = cfg.vehicle_classes if "catv" in df.columns else []
    if per_accident is None:
        per_accident = group_table(df, k, {n: c for n, c in (("nb_v", v), ("nb_u", u)) if c in df.columns}, "catv", classes)
    df = join_group_table(df, per_accident, k, "catv", classes)
    df = drop_if_present(df, R.KEY_COLUMNS_DROPPED if k == "Num_Acc" else
                         [c for c in (k, v, u, "num_veh", "num_veh_x", "num_veh_y")])
    filled = {c: F.coalesce(e.cast("double"), F.lit(med[src.get(c, c)]).cast("double")) for c, e in clipped.items()}
    if "an_nais" in df.columns:
        filled["age"] = (F.col("an") - filled["an_nais"].cast("long")).try_cast("long")
    df = df.withColumns(filled)
    df = df.withColumn("jour_semaine", weekday_name(safe_date("an", "mois", "jour")))
    if "vma" in df.columns:
        df = df.withColumn("vma", clip("vma", None, cfg.vma_cap))
    if "hrmn" in df.columns:
        df = df.withColumn("hr", hour_from_hhmm("hrmn")).drop("hrmn")
    if "lartpc" in df.columns:
        df = df.withColumn("tpc", nonzero_flag("lartpc", null_as=1 if cfg.compat else 0)).drop("lartpc")
    if "dep" in df.columns and regions is not None:
        df = lookup_join(df, "dep", regions, lookup_key, lookup_value, "reg", drop_key=True,
                         order_col="line" if "line" in regions.columns else None)
    if "grav" in df.columns:
        df = collapse_target(df, "grav", R.GRAV_COLLAPSE, R.GRAV_DROP, R.GRAV_SHIFT)
    return df


def add_boolean_features(df: DataFrame, cfg: AccidentConfig) -> DataFrame:
    """Safety-equipment flags over secu1..3 and impact flags over choc."""
    secu = [c for c in R.SECU_COLUMNS if c in df.columns]
    if secu:
        df = df.withColumns(flag_columns(cfg.secu_flags, secu)).drop(*secu)
    if "choc" in df.columns:
        df = df.withColumns(flag_columns(cfg.choc_flags, "choc")).drop("choc")
    return df


def build_user_table(usagers: DataFrame, vehicules: DataFrame, caracteristiques: DataFrame,
                     lieux: DataFrame, regions: DataFrame | None = None,
                     cfg: AccidentConfig | None = None) -> DataFrame:
    """The whole feature plan: joins -> features -> flags -> de-duplication."""
    cfg = cfg or AccidentConfig()
    limit_generated_code(usagers.sparkSession)
    share_partitions(usagers.sparkSession)
    df = join_tables(usagers, vehicules, caracteristiques, lieux, cfg)
    df = engineer_features(df, regions, cfg, per_accident=accident_features(usagers, vehicules, caracteristiques, lieux, cfg))
    df = add_boolean_features(df, cfg)
    return drop_duplicate_rows(df) if cfg.dedup else df


def regions_table(spark) -> DataFrame:
    """The department -> region lookup as a DataFrame (from the fixed values)."""
    import csv
    import io
    rows = list(csv.DictReader(io.StringIO(R.REGIONS_CSV)))
    return spark.createDataFrame([(r["departement"], r["region"], i) for i, r in enumerate(rows)],
                                 "departement string, region string, line int")
