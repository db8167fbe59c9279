"""The movie-site tables, expressed over a folder of TPC-H-like parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AS_OF = "2001-07-31"

# Stand-ins for the fixed tags and places, which this data does not contain.
ANIMATION_TAG = "widget"
NORTH_AMERICA = ("Brand#1", "Brand#24")
MAINLAND = ("Brand#3",)


class Domain:
    """Movie-site tables of one data folder. Nothing is read before a job runs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def movies(self) -> DataFrame:
        name, kind, key = F.col("p_name"), F.col("p_type"), F.col("p_partkey")
        day = F.date_add(F.lit("1990-01-01").cast("date"), (key % 3650).cast("int"))
        return self.table("part").select(
            key.alias("mid"),
            name.alias("movie_name"),
            F.concat(F.lit("img/"), key.cast("string")).alias("img_urls"),
            kind.alias("directors"),
            F.replace(name, F.lit(" "), F.lit("|")).alias("main_actors"),
            F.concat(F.replace(name, F.lit(" "), F.lit("|")), F.lit("|"), kind).alias("categories"),
            F.col("p_brand").alias("location"),
            F.concat(F.lit("lang"), (F.col("p_size") % 5).cast("string")).alias("language"),
            day.cast("string").alias("release_date"),
            F.col("p_retailprice").alias("rating_num"),
            (F.col("p_size") % 7 == 0).cast("int").alias("off_shelf"),
        )

    @property
    def ratings(self) -> DataFrame:
        lines = self.table("lineitem")
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            F.col("o_custkey").alias("uid"),
            F.col("l_partkey").alias("mid"),
            (F.col("l_quantity") * 2).alias("rating"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
            "l_orderkey",
            "l_linenumber",
            "l_suppkey",
        )

    @property
    def newest_by_order(self) -> DataFrame:
        """(uid, newest) of each order: the place of its newest rating in the order of its user's, reduced before lines
        meet their orders.
        """
        lines = self.table("lineitem").select(
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
            "l_orderkey",
            "l_linenumber",
            F.col("l_partkey").alias("mid"),
            "l_suppkey",
        )
        newest = lines.groupBy("l_orderkey").agg(F.max(F.struct("date", *self.RATING_TIE)).alias("newest"))
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        return newest.join(orders, newest.l_orderkey == orders.o_orderkey).select(F.col("o_custkey").alias("uid"), "newest")

    # Orders the ratings of one user and date.
    RATING_TIE = ("l_orderkey", "l_linenumber", "mid", "l_suppkey")

    @property
    def movie_ratings(self) -> DataFrame:
        """Ratings without the user, for jobs that count per movie; the date keeps its type, so filters prune."""
        return self.table("lineitem").select(F.col("l_partkey").alias("mid"), F.col("l_shipdate").alias("date"))

    def _activity(self, kept: Column) -> DataFrame:
        return self.table("lineitem").where(kept).select(F.col("l_partkey").alias("mid"))

    @property
    def comments(self) -> DataFrame:
        return self._activity(F.col("l_returnflag") == "R")

    @property
    def collections(self) -> DataFrame:
        return self._activity(F.col("l_linestatus") == "O")

    @property
    def plays(self) -> DataFrame:
        return self._activity(F.col("l_tax") >= 0.04)

    @property
    def users(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", F.col("n_name").alias("city"))
        customer = self.table("customer")
        key = F.col("c_custkey")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
            key.alias("userId"),
            F.col("c_name").alias("userName"),
            (18 + key % 50).cast("int").alias("age"),
            F.col("c_mktsegment").alias("professional"),
            "city",
            (key % 2).cast("int").alias("sex"),
        )

    @property
    def cities(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            F.col("n_regionkey").alias("pid"),
        )

    def _events(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            "user_id",
            "event_type",
            F.col("ts").cast("timestamp").alias("ts"),
            F.get_json_object("props", "$.k").cast("long").alias("k"),
        )

    @property
    def actions(self) -> DataFrame:
        """User actions; epoch seconds stand for milliseconds, ``event_id`` orders equal times."""
        events = self._events()
        kind, k = F.col("event_type"), F.col("k")
        page = (
            F.when(kind == "view", "index")
            .when(kind == "click", "detail")
            .when(kind == "purchase", "play")
            .when(kind == "signup", "comment")
            .when(k % 2 == 0, "rating")
            .otherwise("collect")
        )
        slots = {"click": "click", "collect": "purchase", "rating": "signup", "comment": "error"}
        return events.select(
            F.unix_seconds("ts").alias("date"),
            F.col("user_id").alias("userId"),
            F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias(
                "sessionId"
            ),
            page.alias("pageId"),
            kind.alias("searchKeyword"),
            *[F.when(kind == e, k % 10).alias(f"{s}CategoryId") for s, e in slots.items()],
            *[F.when(kind == e, k).alias(f"{s}MovieId") for s, e in slots.items()],
            (F.col("user_id") % 25).alias("cityId"),
            "event_id",
        )

    @property
    def log_events(self) -> DataFrame:
        return self._logged()

    def _logged(self, *more: str) -> DataFrame:
        kind = F.col("event_type")
        return self._events().select(
            *more,
            F.col("user_id").alias("uid"),
            F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("ip"),
            F.col("k").alias("mid"),
            F.when(kind == "purchase", "play").otherwise(kind).alias("event"),
            F.unix_millis("ts").alias("timestamp"),
        )

    @property
    def log_lines(self) -> DataFrame:
        """The log events as text lines."""
        fields = [F.col(c).cast("string") for c in ("uid", "ip", "mid", "event", "timestamp")]
        return self.log_events.select(F.concat_ws("|", *fields).alias("value"))

    def arriving_log_events(self, parts: int) -> DataFrame:
        """Log events with the number of the arrival that brings them: equal stretches of time, and every 97th last."""
        logged = self._logged("event_id")
        ends = logged.agg(F.min("timestamp").alias("_from"), F.max("timestamp").alias("_to"))
        part = F.floor((F.col("timestamp") - F.col("_from")) * parts / (F.col("_to") - F.col("_from") + 1))
        arrival = F.when(F.col("event_id") % 97 == 0, F.lit(parts - 1)).otherwise(part).cast("int")
        return logged.crossJoin(F.broadcast(ends)).withColumn("arrival", arrival).drop("event_id", "_from", "_to")

    @property
    def raw_log_lines(self) -> DataFrame:
        """The log lines as they might arrive: every seventh lacks a field, every eleventh has a broken number."""
        fields = [F.col(c).cast("string") for c in ("uid", "ip", "mid", "event", "timestamp")]
        event = F.col("event_id")
        broken = F.when(event % 7 == 0, F.concat_ws("|", *fields[:4])).when(
            event % 11 == 0, F.concat_ws("|", *fields[:4], F.lit("soon"))
        )
        return self._logged("event_id").select(F.coalesce(broken, F.concat_ws("|", *fields)).alias("value"))

    @property
    def logins(self) -> DataFrame:
        outcome = F.when(F.col("event_type") == "error", "fail").otherwise("success")
        return self._events().select(
            F.col("user_id").alias("uid"),
            outcome.alias("eventType"),
            F.unix_millis("ts").alias("timestamp"),
            "event_id",
        )

    @property
    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("mid"), F.col("embedding").cast("array<double>").alias("vector")
        )


class StreamedDomain(Domain):
    """The same tables, with the events arriving as a stream of files."""

    def table(self, name: str) -> DataFrame:
        stored = super().table(name)
        if name != "events":
            return stored
        reader = self.spark.readStream.schema(stored.schema)
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(self.folder)
