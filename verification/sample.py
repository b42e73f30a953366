"""The given tables, read as logistics data (whole tables; every input grows with them).

    supplier -> fulfillment centers     customer -> delivery stations     part -> vehicles
    events   -> shipment events: one shipment per user and day, seven stages
    events   -> orders of those shipments; orders, lineitem -> order messages
The SQL text of the same mapping is in oracles.py.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelake import domain
from parcelake.operators import bi, scd2
from parcelake.operators.calendar import dim_date
from parcelake.operators.checks import expected_arrival, promised_time
from parcelake.operators.clean import valid_rows
from parcelake.operators.enrich import add_flags, enrich
from parcelake.operators.fact import fact_shipment, shipment_states
from parcelake.operators.live import changed_rows, to_live_rows
from parcelake.plans.gold import customers
from parcelake.schemas import ENTITIES, SHIPMENT_LIVE, empty
from parcelake.session import apply_runtime_conf


def as_of() -> Column:
    return F.lit("2027-06-30 00:00:00").cast("timestamp")


def _id(prefix: str, number: Column | str) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), number.cast("bigint").cast("string"))


def _latitude(number: Column) -> Column:
    return number.cast("double") / F.lit(50.0) + F.lit(10.0)


def _longitude(number: Column) -> Column:
    return number.cast("double") / F.lit(100.0) + F.lit(70.0)


@dataclass(frozen=True)
class Sample:
    spark: SparkSession
    sf_dir: str

    def __post_init__(self) -> None:
        apply_runtime_conf(self.spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- master data ---------------------------------------------------------------

    @staticmethod
    def _facility(rows: DataFrame, entity: str, prefix: str, source: str) -> DataFrame:
        key, nation = F.col(f"{source}_key"), F.col(f"{source}_nationkey")
        return rows.select(
            _id(prefix, key).alias(f"{entity}_id"),
            F.col(f"{source}_name").alias(f"{entity}_name"),
            _id("CITY_", nation).alias("city"),
            _id("REGION_", nation % 5).alias("region"),
            _id("STATE_", nation).alias("state"),
            F.floor(F.col(f"{source}_acctbal")).cast("int").alias("daily_capacity"),
            _latitude(key).alias("latitude"), _longitude(key).alias("longitude"))

    def raw_centers(self) -> DataFrame:
        rows = self.table("supplier").withColumnRenamed("s_suppkey", "s_key")
        return self._facility(rows, "fulfillment_center", "FC_", "s")

    def raw_stations(self) -> DataFrame:
        rows = self.table("customer").withColumnRenamed("c_custkey", "c_key")
        return self._facility(rows, "delivery_station", "DS_", "c")

    def raw_vehicles(self) -> DataFrame:
        size, kind = F.col("p_size"), F.col("p_type")
        return self.table("part").select(
            _id("VEH_", "p_partkey").alias("vehicle_id"),
            F.when(size % 3 == 0, "TRUCK").when(size % 3 == 1, "VAN").otherwise("BIKE")
            .alias("vehicle_type"),
            _id("DS_", "p_partkey").alias("home_facility_id"),
            F.lit(domain.DS).alias("home_facility_type"),
            size.alias("capacity"),
            F.when(kind == "SMALL", "IN_USE").when(kind == "LARGE", "MAINTENANCE")
            .when(kind == "PROMO", "RETIRED").otherwise("AVAILABLE").alias("status"))

    @cached_property
    def centers(self) -> DataFrame:
        return self.raw_centers().where(valid_rows(ENTITIES[domain.TOPIC_FULFILLMENT_CENTERS]))

    @cached_property
    def stations(self) -> DataFrame:
        return self.raw_stations().where(valid_rows(ENTITIES[domain.TOPIC_DELIVERY_STATIONS]))

    @cached_property
    def vehicles(self) -> DataFrame:
        return self.raw_vehicles().where(valid_rows(ENTITIES[domain.TOPIC_VEHICLES]))

    # --- shipment events and orders ---------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        user, value, kind = F.col("user_id"), F.col("value"), F.col("event_type")
        ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
        day = F.date_format(ts, "yyyy-MM-dd")
        light = value < 30
        status = (
            F.when((kind == "signup") & light, domain.ALLOCATED)
            .when(kind == "signup", domain.PACKED)
            .when(kind == "view", domain.DISPATCHED)
            .when((kind == "click") & light, domain.AT_STATION)
            .when(kind == "click", domain.ASSIGNED)
            .when(kind == "error", domain.ON_ROUTE)
            .otherwise(domain.DELIVERED))
        at_fc = kind.isin("signup", "view")
        at_ds = kind == "click"
        center, station = F.floor(user / 2), user * 7
        shift = (value - F.lit(50.0)) / F.lit(10000.0)
        base = F.when(at_fc, center).otherwise(station)
        typed = self.table("events").select(
            _id("EVT_", "event_id").alias("event_id"),
            # users spread over seven years, the last of them beyond the calendar
            F.timestamp_add("DAY", ((user % 90) * 30).cast("int"), ts).alias("event_timestamp"),
            F.concat(_id("SHP_", user), F.lit("_"), day).alias("shipment_id"),
            F.concat(_id("ORD_", user), F.lit("_"), day).alias("order_id"),
            _id("CUST_", user).alias("customer_id"),
            status.alias("shipment_status"),
            F.when(at_fc, _id("FC_", center)).when(at_ds, _id("DS_", station))
            .alias("facility_id"),
            F.when(at_fc, domain.FC).when(at_ds, domain.DS).alias("facility_type"),
            F.when((kind == "view") | (at_ds & light), _id("VEH_", user * 3))
            .when(at_ds | kind.isin("error", "purchase"), _id("VEH_", user * 5 + 1))
            .alias("vehicle_id"),
            F.when((user + F.day(ts)) % 10 < 3, domain.PRIME).otherwise(domain.STANDARD)
            .alias("customer_tier"),
            F.when((user + F.day(ts)) % 3 == 0, domain.SAME_DAY).otherwise(domain.STANDARD)
            .alias("delivery_type"),
            (value > 100).alias("is_delayed"),
            F.when(value > 100, F.floor(value)).otherwise(0).cast("int").alias("delay_minutes"),
            (_latitude(base) + shift).alias("latitude"),
            (_longitude(base) - shift).alias("longitude"),
            value)
        promised = promised_time(
            F.date_trunc("day", F.col("event_timestamp")), F.col("delivery_type"))
        return (
            typed.withColumn("promised_delivery_time", promised)
            .withColumn("estimated_delivery_time",
                        expected_arrival("promised_delivery_time", "delay_minutes"))
        )

    @cached_property
    def orders(self) -> DataFrame:
        """One order per shipment; orders over 300 name a center their station is not served by."""
        user = F.regexp_extract("customer_id", "[0-9]+", 0).cast("bigint")
        value = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
        return (
            self.events.groupBy("order_id", "shipment_id", "customer_id", "customer_tier",
                                "delivery_type", "promised_delivery_time")
            .agg(F.min("event_timestamp").alias("event_timestamp"), value.alias("order_value"))
            .withColumn("fulfillment_center_id", _id(
                "FC_", F.floor(user / 2) + (F.col("order_value") > 300).cast("int")))
            .withColumn("delivery_station_id", _id("DS_", user * 7))
        )

    @cached_property
    def network(self) -> DataFrame:
        """Which center serves which station."""
        key = F.col("c_custkey")
        return self.table("customer").select(
            _id("FC_", F.floor(key / 14)).alias("fulfillment_center_id"),
            _id("DS_", key).alias("delivery_station_id"))

    # --- live table --------------------------------------------------------------------

    @cached_property
    def enriched(self) -> DataFrame:
        return add_flags(enrich(self.events, self.centers, self.stations, self.vehicles))

    def live_of(self, events: DataFrame) -> DataFrame:
        """Live table after these events, stamped with event time."""
        nothing = empty(self.spark, SHIPMENT_LIVE)
        return changed_rows(self.live_rows(events), nothing)

    def live_rows(self, events: DataFrame) -> DataFrame:
        return to_live_rows(events, self.centers, self.stations)

    @cached_property
    def flagged(self) -> DataFrame:
        return add_flags(self.events)

    @cached_property
    def live(self) -> DataFrame:
        return self.live_of(self.events)

    # --- star schema ---------------------------------------------------------------------

    def first_load(self, dim: scd2.Dimension, incoming: DataFrame) -> DataFrame:
        return scd2.first_versions(incoming, dim, F.lit("2024-01-01"))

    @cached_property
    def dim_fc(self) -> DataFrame:
        return self.first_load(scd2.DIM_FULFILLMENT_CENTER, self.centers)

    @cached_property
    def dim_ds(self) -> DataFrame:
        return self.first_load(scd2.DIM_DELIVERY_STATION, self.stations)

    @cached_property
    def dim_vehicle(self) -> DataFrame:
        return self.first_load(scd2.DIM_VEHICLE, self.vehicles)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.first_load(scd2.DIM_CUSTOMER, customers(self.orders))

    # second loads

    def _grown(self, dim: scd2.Dimension, rows: DataFrame) -> DataFrame:
        """Facilities above capacity 5000 grow by a tenth."""
        grown = rows.withColumn(
            "daily_capacity", F.when(F.col("daily_capacity") > 5000, F.floor(
                F.col("daily_capacity") + F.col("daily_capacity") / 10)).otherwise(
                F.col("daily_capacity")).cast("int"))
        return scd2.merge(self.first_load(dim, rows), grown, dim, F.lit("2024-02-01"))

    @cached_property
    def fc_history(self) -> DataFrame:
        return self._grown(scd2.DIM_FULFILLMENT_CENTER, self.centers)

    @cached_property
    def ds_history(self) -> DataFrame:
        return self._grown(scd2.DIM_DELIVERY_STATION, self.stations)

    @cached_property
    def vehicle_history(self) -> DataFrame:
        """Vehicles in use become available."""
        freed = self.vehicles.withColumn("status", F.when(
            F.col("status") == "IN_USE", "AVAILABLE").otherwise(F.col("status")))
        return scd2.merge(self.dim_vehicle, freed, scd2.DIM_VEHICLE, F.lit("2024-02-01"))

    @cached_property
    def calendar(self) -> DataFrame:
        return dim_date(self.spark)

    @cached_property
    def fact(self) -> DataFrame:
        return fact_shipment(
            shipment_states(self.events), self.orders, self.vehicles, self.dim_fc, self.dim_ds,
            self.dim_vehicle, self.dim_customer, self.calendar, as_of())

    @cached_property
    def bi(self) -> dict[str, DataFrame]:
        """The six BI tables as the job makes them: from one roll-up of the fact."""
        return bi.bi_tables(bi.rollup(self.fact), self.dim_fc, self.dim_ds, self.calendar)

    # --- type-2 sample: customer tiers as known in April 1998 and at the end -------------

    @cached_property
    def trade_orders(self) -> DataFrame:
        """The orders table in the columns of silver orders; urgent and high priority is PRIME."""
        urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        return self.table("orders").select(
            _id("ORD_", "o_orderkey").alias("order_id"),
            _id("CUST_", "o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("timestamp").alias("event_timestamp"),
            F.when(urgent, domain.PRIME).otherwise(domain.STANDARD).alias("customer_tier"),
            F.when(F.col("o_orderstatus") == "F", domain.SAME_DAY).otherwise(domain.STANDARD)
            .alias("delivery_type"),
            F.col("o_totalprice").alias("order_value"))

    @cached_property
    def tiers_before(self) -> DataFrame:
        return customers(self.trade_orders.where("event_timestamp < '1998-04-01'"))

    @cached_property
    def tiers_after(self) -> DataFrame:
        return customers(self.trade_orders.where("event_timestamp >= '1998-04-01'"))

    @cached_property
    def tiers_first(self) -> DataFrame:
        return scd2.first_versions(self.tiers_before, scd2.DIM_CUSTOMER, F.lit("1995-01-01"))

    @cached_property
    def tier_history(self) -> DataFrame:
        """dim_customer after both loads."""
        return scd2.merge(
            self.tiers_first, self.tiers_after, scd2.DIM_CUSTOMER, F.lit("1998-04-01"))
