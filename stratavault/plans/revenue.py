"""The revenue warehouse: raw vault, business vault, mart and report layers as DataFrame plans.

Column and member names are those of the business files. Fixed values: the stage column names and the
dimension members below.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavault.functions.keys import first_of_month, hash_key
from stratavault.operators import vault as v
from stratavault.operators.relational import difference
from stratavault.session import materialise
from stratavault.sinks import tables as sinks
from stratavault.sinks.keyed import RANGES_SUFFIX, ROWS_PER_RANGE, Loaded, keyed_rows, load_keyed

Store = Callable[[DataFrame, str], DataFrame]

# Stage columns.
CENTER, YEAR, MONTH, CHANNEL, SECTOR, ROAD = "ЧУЗ", "Год", "Мес", "Канал", "Сектор", "Дорога"
PLAN, APPROVED, FACT = "План КДРО, руб.", "План утвержденный, руб.", "Факт, руб."
REVENUE_SOURCE, DIRECTORY_SOURCE = "База выручки", "Справочник"

# Dimension members that the links and the business layer look up.
METRIC_FACT = "Факт"
UNIT_ROUBLE, UNIT_THOUSAND = "Рубль", "Тысяча рублей"
DATA_PRIMARY, DATA_DERIVED = "первичный", "расчетный"
STEP_MONTH, STEP_YEAR = "месяц", "год"
VALUE_DAILY, VALUE_RUNNING, VALUE_TOTAL = (
    "нарастающий итог по суткам с начала месяца", "нарастающий итог по месяцам с начала года", "итог")
SECTOR_PAID = "ПМУ"

DIRECTORIES = ("unit", "metric", "data_type", "discreteness", "value_type")
BUSINESS_LINKS = ("road", "medical_center", "value_type", "unit", "discreteness", "metric", "data_type")
GRAIN_KEYS = ["road_hk", "medical_center_hk", "value_type_hk", "unit_hk", "discreteness_hk", "metric_hk", "data_type_hk"]


@dataclass(frozen=True)
class Stage:
    """Inputs of the raw vault: the revenue file and the directories."""

    revenue: DataFrame
    roads: DataFrame
    centers: DataFrame
    channels: DataFrame
    directories: Mapping[str, DataFrame]  # name -> frame with a ``fullname`` column


def period():
    return first_of_month(F.col(YEAR), F.col(MONTH))


def revenue_keys() -> list:
    """Business key of a revenue row; the only definition used by hub, satellite and links."""
    return [F.col(CENTER), period(), F.col(CHANNEL)]


def revenue_grain(revenue: DataFrame) -> DataFrame:
    """Distinct key columns of the stage, the only part of it that hubs and links need."""
    return revenue.select(CENTER, YEAR, MONTH, CHANNEL, SECTOR, ROAD).distinct()


def hub_revenue(revenue: DataFrame, load_ts: str) -> DataFrame:
    return v.hub(revenue, "revenue_hk", revenue_keys(), {
        "year": F.col(YEAR).try_cast("int"), "month": F.col(MONTH).try_cast("int"),
        "sales_channel": CHANNEL, "medical_center": CENTER, "period": period()}, load_ts, REVENUE_SOURCE)


def sat_revenue(revenue: DataFrame, load_ts: str) -> DataFrame:
    return v.satellite(revenue, "revenue_hk", revenue_keys(), {
        "plan_kdro__rub": v.measure(F.col(f"`{PLAN}`")),
        "plan_approved__rub": v.measure(F.col(f"`{APPROVED}`")),
        "fact__rub": v.measure(F.col(f"`{FACT}`"))}, load_ts, REVENUE_SOURCE, keep_all=True)


class Tables(Mapping[str, DataFrame]):
    """Tables of one layer, each planned when first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def raw_vault(stage: Stage, load_ts: str, store: Store = materialise, sectors: DataFrame | None = None) -> Tables:
    """All raw-vault tables by name (``hub_*``, ``sat_*``, ``link_*``). ``sectors`` has the sectors that were numbered before
    (shortname, id).

    The folded key columns, the revenue hub and the ranked sectors are stored once; what builds on them reads
    the stored rows instead of the raw stage.
    """
    make: dict[str, Callable[[], DataFrame]] = {"grain": lambda: store(revenue_grain(stage.revenue), "revenue_grain")}
    tables = Tables(make)

    def grain() -> DataFrame:
        return tables["grain"]

    def hub_of(df: DataFrame, entity: str, column: str, out: str):
        make[f"hub_{entity}"] = lambda: v.hub(df, f"{entity}_hk", [F.col(column)], {out: F.col(column)}, load_ts, DIRECTORY_SOURCE)

    def directory_of(df: DataFrame, entity: str, column: str):
        make[f"sat_{entity}"] = lambda: directory_satellite(df, entity, column, load_ts)

    def named_link(entity: str, column: str):
        make[f"link_{entity}"] = lambda: v.link_by_name(
            grain(), tables[f"hub_{entity}"], f"{entity}_hk", F.col(column), tables["hub_revenue"], "revenue_hk",
            revenue_keys(), f"link_{entity}_revenue_hk", load_ts, REVENUE_SOURCE)

    def constant_link(entity: str, member: str, keep_missing: bool = False, keys: list | None = None):
        make[f"link_{entity}"] = lambda: v.link_to_constant(
            grain(), tables[f"hub_{entity}"], f"{entity}_hk", "fullname", member,
            tables["hub_revenue"], "revenue_hk", f"link_{entity}_revenue_hk", load_ts, REVENUE_SOURCE,
            keep_missing=keep_missing, right_keys=keys)

    make["hub_revenue"] = lambda: store(hub_revenue(grain(), load_ts), "hub_revenue")
    make["sat_revenue"] = lambda: sat_revenue(stage.revenue, load_ts)
    make["sat_sales_sector"] = lambda: store(sat_sales_sector(grain(), load_ts, sectors), "sat_sales_sector")
    hub_of(stage.roads, "road", "fullname", "fullname")
    hub_of(stage.centers, "medical_center", "fullname", "medical_center")
    hub_of(stage.channels, "sales_channel", "shortname", "shortname")
    make["hub_sales_sector"] = lambda: v.hub(grain(), "sales_sector_hk", [F.col(SECTOR)], {"shortname": F.col(SECTOR)},
                                             load_ts, REVENUE_SOURCE)
    directory_of(stage.roads, "road", "fullname")
    directory_of(stage.centers, "medical_center", "fullname")
    directory_of(stage.channels, "sales_channel", "shortname")
    for name in DIRECTORIES:
        hub_of(stage.directories[name], name, "fullname", "fullname")
        directory_of(stage.directories[name], name, "fullname")
    named_link("road", ROAD)
    named_link("medical_center", CENTER)
    named_link("sales_channel", CHANNEL)
    named_link("sales_sector", SECTOR)
    constant_link("discreteness", STEP_MONTH)
    constant_link("data_type", DATA_PRIMARY, keep_missing=True)
    constant_link("metric", METRIC_FACT, keep_missing=True)
    constant_link("unit", UNIT_ROUBLE, keep_missing=True)
    constant_link("value_type", VALUE_DAILY, keys=revenue_keys())
    return tables


def directory_satellite(df: DataFrame, entity: str, key: str, load_ts: str) -> DataFrame:
    """All columns of a directory as attributes."""
    return v.satellite(df, f"{entity}_hk", [F.col(key)], {c: F.col(f"`{c}`") for c in df.columns}, load_ts, DIRECTORY_SOURCE)


def sat_sales_sector(revenue: DataFrame, load_ts: str, known: DataFrame | None = None) -> DataFrame:
    """Sectors with their numbers: in name order at first, and those of new sectors behind them."""
    ranked = v.lasting_ids(revenue.select(F.col(SECTOR).alias("shortname")), known, "shortname", "id")
    audit = v.load_columns(load_ts, REVENUE_SOURCE)
    return ranked.select(hash_key("shortname").alias("sales_sector_hk"), audit[0], "shortname", "id",
                         F.col("shortname").alias("fullname"), audit[1])


def newest_delivery(sums: DataFrame, value: str) -> DataFrame:
    """Of sums per revenue key and load the newest per key."""
    return sums.groupBy("revenue_hk").agg(F.max_by(value, "load_date").alias(value))


def business_revenue(raw: Mapping[str, DataFrame], sector: str = SECTOR_PAID) -> DataFrame:
    """Fact sums of one sector by month and by year, each grain with its own labels.

    Of every revenue key the measures of its newest delivery count: those of an older one give way where the key comes
    again. The measure satellite is summed per revenue key before any join, so the joins see one row per key however
    many rows the satellite holds. All of them use the same key.
    """
    facts = newest_delivery(raw["sat_revenue"].groupBy("revenue_hk", "load_date").agg(F.sum("fact__rub").alias("fact")), "fact")
    rows = raw["hub_revenue"].select("revenue_hk", "year", "month").join(facts, "revenue_hk")
    for entity in ("road", "medical_center"):
        rows = rows.join(raw[f"link_{entity}"].select(f"{entity}_hk", "revenue_hk"), "revenue_hk")
    # these links only decide whether a key takes part
    for entity in ("sales_channel", "discreteness", "value_type", "data_type"):
        rows = rows.join(raw[f"link_{entity}"].select("revenue_hk"), "revenue_hk", "left_semi")
    # members of the newest directory load; most rows of a link may share one of them
    for entity, condition in (("unit", None), ("metric", None), ("sales_sector", F.col("shortname") == sector)):
        current = v.latest_batch(raw[f"sat_{entity}"])
        members = current if condition is None else current.where(condition)
        linked = v.known_keys(raw[f"link_{entity}"].select(f"{entity}_hk", "revenue_hk"), members, f"{entity}_hk", "revenue_hk")
        if condition is None:
            rows = rows.join(linked, "revenue_hk")
        else:
            rows = rows.join(linked, "revenue_hk", "left_semi")

    def member(entity: str, name: str):
        return v.key_of(v.latest_batch(raw[f"sat_{entity}"]), f"{entity}_hk", "fullname", name)

    shared = ["road_hk", "medical_center_hk", "unit_hk", "metric_hk"]
    columns = [F.col(c) for c in ["year", "month", *shared]]
    by_month, by_year = columns, [c for c in columns if c is not columns[1]]
    sums = rows.groupingSets([by_month, by_year], *columns).agg(
        F.sum("fact").alias("value"), F.grouping("month").alias("_yearly"))

    def per_grain(entity: str, monthly: str, yearly: str):
        return F.when(F.col("_yearly") == 0, member(entity, monthly)).otherwise(member(entity, yearly)).alias(f"{entity}_hk")

    labelled = sums.select(
        "year", "month", "value", *shared, per_grain("value_type", VALUE_RUNNING, VALUE_TOTAL),
        per_grain("discreteness", STEP_MONTH, STEP_YEAR), member("data_type", DATA_DERIVED).alias("data_type_hk"))
    complete = labelled.where("value_type_hk IS NOT NULL AND discreteness_hk IS NOT NULL AND data_type_hk IS NOT NULL")
    return complete.select(hash_key("year", "month", *GRAIN_KEYS).alias("revenue_hk"), "year", "month", *GRAIN_KEYS, "value")


def hub_business_revenue(business: DataFrame, load_ts: str) -> DataFrame:
    return business.drop("value").select("*", *v.load_columns(load_ts, REVENUE_SOURCE))


def sat_business_revenue(business: DataFrame, load_ts: str) -> DataFrame:
    audit = v.load_columns(load_ts, REVENUE_SOURCE)
    return business.select("revenue_hk", audit[0], "value", audit[1])


def business_vault(raw: Mapping[str, DataFrame], load_ts: str, store: Store = materialise) -> Tables:
    """Business hubs (pass-through), current satellites, revenue hub and satellite, links.

    The aggregate behind the revenue hub and satellite is computed and stored once.
    """
    make: dict[str, Callable[[], DataFrame]] = {
        "revenue": lambda: store(business_revenue(raw), "business_revenue"),
        "hub_revenue": lambda: hub_business_revenue(tables["revenue"], load_ts),
        "sat_revenue": lambda: sat_business_revenue(tables["revenue"], load_ts),
        "link_sales_channel": lambda: v.relink(raw["link_sales_channel"], "sales_channel_hk", "revenue_hk",
                                               "link_sales_channel_revenue_hk", load_ts, REVENUE_SOURCE)}
    tables = Tables(make)

    def passed_on(entity: str):
        make[f"hub_{entity}"] = lambda: raw[f"hub_{entity}"]
        make[f"sat_{entity}"] = lambda: v.latest_per_key(raw[f"sat_{entity}"], f"{entity}_hk")

    def linked(entity: str):
        make[f"link_{entity}"] = lambda: v.link_between(
            tables[f"hub_{entity}"], tables["hub_revenue"], f"{entity}_hk", "revenue_hk",
            f"link_{entity}_revenue_hk", load_ts, REVENUE_SOURCE)

    for entity in (*DIRECTORIES, "road", "medical_center", "sales_channel"):
        passed_on(entity)
    for entity in BUSINESS_LINKS:
        linked(entity)
    return tables


def mart_fact(hub: DataFrame, sat: DataFrame, current_units: DataFrame) -> DataFrame:
    """Revenue in thousands with one date per row; the unit is relabelled by a scalar lookup."""
    thousand = v.key_of(current_units, "unit_hk", "fullname", UNIT_THOUSAND)
    joined = hub.drop("load_date", "source_system").join(sat.select("revenue_hk", "value"), "revenue_hk")
    return joined.select(
        first_of_month("year", F.coalesce("month", F.lit(1))).alias("date"), "road_hk", "medical_center_hk",
        "value_type_hk", "discreteness_hk", thousand.alias("unit_hk"), "metric_hk", "data_type_hk",
        (F.col("value") / 1000).alias("value")).where("unit_hk IS NOT NULL")


def mart_dimension(current: DataFrame) -> DataFrame:
    """A current satellite without its audit columns."""
    return current.drop("load_date", "source_system")


# Names in the report layer.
REPORT_NAMES = {"fullname": "full_name", "medical_center_hk": "med_center_hk"}


def report(df: DataFrame) -> DataFrame:
    """Report view of a mart table: the same rows under the report's names."""
    return df.withColumnsRenamed({k: n for k, n in REPORT_NAMES.items() if k in df.columns})


def mart(business: Mapping[str, DataFrame]) -> Tables:
    """Star schema: seven dimensions and the revenue fact."""
    make: dict[str, Callable[[], DataFrame]] = {
        "pmu_revenue": lambda: mart_fact(business["hub_revenue"], business["sat_revenue"], business["sat_unit"])}
    for entity in (*DIRECTORIES, "road", "medical_center"):
        make[entity] = lambda entity=entity: mart_dimension(business[f"sat_{entity}"])
    return Tables(make)


#: Satellites keep every load; the first column of a stored hub or link is its key.
SATELLITES = ("sat_revenue", "sat_sales_sector", *(f"sat_{e}" for e in (*DIRECTORIES, "road", "medical_center", "sales_channel")))
#: Tables that are loaded at a time.
AT_ONCE = 4


def load(stage: Stage, load_ts: str, database: str, names: Iterable[str] | None = None, full_refresh: bool = False) -> dict[str, str]:
    """Load one delivery into stored raw-vault tables, some at a time; returns their names.

    Satellites gain the rows of this load, or replace them if the load is repeated; ``full_refresh`` starts them anew.
    Hubs and links keep one row per key, the last write. Sectors keep the numbers they have. ``names`` limits the load
    to some tables.
    """
    spark, sectors = stage.revenue.sparkSession, f"{database}.sat_sales_sector"
    # numbers as they are before this load, if any
    known = materialise(spark.table(sectors).select("shortname", "id"), "sectors") if sinks.exists(spark, sectors) else None
    raw = raw_vault(stage, load_ts, sectors=known)
    wanted = list(names or [n for n in raw if n != "grain"])
    for shared in ("grain", "hub_revenue"):
        raw[shared]
    planned = [(name, raw[name], f"{database}.{name}") for name in wanted]  # plans are made here, not by several threads

    def one(item: tuple[str, DataFrame, str]) -> None:
        name, rows, stored = item
        if name in SATELLITES:
            sinks.append_history(rows, stored, full_refresh, load_ts)
        else:
            load_keyed(rows, stored, [rows.columns[0]])

    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(inheritable_thread_target(spark)(one), planned))
    return {name: stored for name, _, stored in planned}


def stored_raw(spark: SparkSession, database: str) -> Tables:
    """The raw vault as it is stored, all loads of it."""
    found = [t.name for t in spark.catalog.listTables(database) if t.name.startswith(("hub_", "sat_", "link_")) and not t.name.endswith(RANGES_SUFFIX)]
    return Tables({name: lambda name=name: keyed_rows(spark, f"{database}.{name}") for name in found})


def stored_layers(spark: SparkSession, database: str, load_ts: str, store: Store = materialise) -> dict[str, Tables]:
    """Business vault, mart and report over the stored raw vault."""
    return _above(stored_raw(spark, database), load_ts, store)


BUSINESS_TABLE = "business_revenue"
_GROUP = ["year", "road_hk", "medical_center_hk"]


def _members(raw: Mapping[str, DataFrame]) -> DataFrame:
    """What the aggregate takes from the newest directory loads; where it changes, every group may."""
    parts = [v.latest_batch(raw[f"sat_{e}"]).select(F.lit(e).alias("entity"), F.col(f"{e}_hk").alias("member"), (F.col("shortname") if e == "sales_sector" else F.lit(None).cast("string")).alias("name"))
             for e in ("unit", "metric", "sales_sector")]
    parts += [v.latest_batch(raw[f"sat_{e}"]).select(F.lit(e).alias("entity"), F.col(f"{e}_hk").alias("member"), F.col("fullname").alias("name"))
              for e in ("value_type", "discreteness", "data_type")]
    return reduce(DataFrame.unionByName, parts).distinct()


def touched_keys(raw: Mapping[str, DataFrame], load_ts: str) -> DataFrame:
    """revenue_hk of all revenue keys that share a group (year, road, center) with a key of this load."""
    placed = raw["hub_revenue"].select("revenue_hk", "year", "load_date")
    for entity in ("road", "medical_center"):
        placed = placed.join(raw[f"link_{entity}"].select(f"{entity}_hk", "revenue_hk"), "revenue_hk")
    placed = materialise(placed, "placed-keys")
    groups = materialise(placed.where(F.col("load_date") == F.lit(load_ts).cast("timestamp_ntz")).select(*_GROUP).distinct(), "touched-groups")
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _GROUP]
    met = placed.join(groups.withColumnsRenamed({c: f"_{c}" for c in _GROUP}), on[0] & on[1] & on[2], "left_semi")
    return met.select("revenue_hk").distinct()


def load_business(spark: SparkSession, database: str, load_ts: str, rows_per_range: int = ROWS_PER_RANGE) -> Loaded:
    """Bring the stored business aggregate up to the stored raw vault after the delivery of ``load_ts``.

    Only groups (both grains) that share year, road and center with a delivered key are summed again; sums that stay as
    they are keep their rows and load date, and groups that are gone are removed. Where the newest directory loads have
    other members than those that the aggregate was made with, all groups are summed.
    """
    raw, name, members = stored_raw(spark, database), f"{database}.{BUSINESS_TABLE}", f"{database}.{BUSINESS_TABLE}_members"
    now = materialise(_members(raw), "business-members")
    same = sinks.exists(spark, name) and sinks.exists(spark, members) and difference(now, spark.table(members)).isEmpty() and difference(spark.table(members), now).isEmpty()
    narrowed, keys = raw, None
    if same:
        keys = materialise(touched_keys(raw, load_ts), "touched-keys")
        narrowed = {n: raw[n] for n in raw} | {n: raw[n].join(keys, "revenue_hk", "left_semi") for n in ("hub_revenue", "sat_revenue")}
    sums = business_revenue(narrowed).select("*", *v.load_columns(load_ts, REVENUE_SOURCE))
    grain = ["year", "month", *GRAIN_KEYS]
    removed = None
    if sinks.exists(spark, name):
        removed = keyed_rows(spark, name).select(*grain)
        if same:
            placed = raw["hub_revenue"].select("revenue_hk", "year").join(keys, "revenue_hk", "left_semi")
            for entity in ("road", "medical_center"):
                placed = placed.join(raw[f"link_{entity}"].select(f"{entity}_hk", "revenue_hk"), "revenue_hk")
            groups = placed.select(*[F.col(c).alias(f"_{c}") for c in _GROUP]).distinct()
            on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _GROUP]
            removed = removed.join(groups, on[0] & on[1] & on[2], "left_semi")
    done = load_keyed(sums, name, grain, rows_per_range=rows_per_range, compare=["value"], removed=removed)
    sinks.rebuild(now, members)
    return done


def _above(raw: Mapping[str, DataFrame], load_ts: str, store: Store) -> dict[str, Tables]:
    business = business_vault(raw, load_ts, store)
    marts = mart(business)
    return {"bdv": business, "mart": marts, "report": Tables({name: lambda name=name: report(marts[name]) for name in marts})}


def build(stage: Stage, load_ts: str, store: Store = materialise) -> dict[str, Tables]:
    """All layers from stage to report. ``store`` decides how shared results are kept."""
    raw = raw_vault(stage, load_ts, store)
    return {"rdv": raw, **_above(raw, load_ts, store)}
