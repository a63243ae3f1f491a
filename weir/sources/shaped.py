"""The driver's star-schema tables shaped as the reference's sources.

The reference reads document collections, an IoT CSV export and JSON/XML
documents stored in table columns. These functions derive such sources from
the given tables with plain DataFrame expressions, row for row, so every
query's work grows with the tables. They shape inputs only; they never
compute an answer.

Every derived document carries ``_src`` (file, block, row) with the natural
key of the row it came from as ``row``, standing in for source order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions.text import xml_escape
from weir.sources.files import SRC, source_order


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names]


def _src(row: Column) -> Column:
    return source_order(F.lit(""), F.lit(0), row)


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def iso_text(ts: Column, offset_hours: Column) -> Column:
    """ISO-8601 text of a UTC instant as seen at a whole-hour offset, e.g.
    ``1998-10-03T03:00:00.000000+03:00``."""
    local = ts + F.make_dt_interval(hours=offset_hours)
    sign = F.when(offset_hours < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        sign,
        F.lpad(F.abs(offset_hours).cast("string"), 2, "0"),
        F.lit(":00"),
    )


def _order_start(orders: DataFrame) -> Column:
    return F.col("o_orderdate").cast("timestamp")


def order_offset() -> Column:
    """Urgent orders are written at +03:00, the rest at +00:00."""
    return F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(3)).otherwise(F.lit(0))


def order_duration() -> Column:
    """A session length in seconds, 5 minutes to 4 hours, from the order key."""
    return F.lit(300) + F.pmod(F.col("o_orderkey") * 37, F.lit(14100))


def per_order(side: DataFrame) -> DataFrame:
    """A per-order side (lines grouped by order, or the orders themselves)
    joined to the other on the order key. Both grow with the data, so the
    join is a shuffle join on the key, never a broadcast: the planner sizes
    such a side from compressed file bytes and would otherwise broadcast
    gathered line arrays and run the whole probe side in its scan tasks."""
    return side.hint("merge")


def order_pages(lineitem: DataFrame) -> DataFrame:
    """``vid_<partkey>`` of each order's lines, sorted (lines per order are
    bounded by the order model)."""
    return lineitem.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.concat(F.lit("vid_"), _s("l_partkey")))).alias("pages")
    )


# ---- WatchSessions ← orders + lineitem ---------------------------------------


def watch_session_docs(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    pages = per_order(order_pages(lineitem))
    o = orders.join(pages, orders.o_orderkey == pages.l_orderkey, "left")
    start = _order_start(o)
    end = start + F.make_dt_interval(secs=order_duration())
    off = order_offset()
    device = (
        F.when(F.pmod("o_custkey", F.lit(3)) == 0, F.struct(F.lit("tv").alias("type"), F.lit("Tizen").alias("os"), F.lit("SmartTV").alias("app")))
        .when(F.pmod("o_custkey", F.lit(3)) == 1, F.struct(F.lit("mobile").alias("type"), F.lit("iOS").alias("os"), F.lit("StreamingApp").alias("app")))
        .otherwise(F.struct(F.lit("desktop").alias("type"), F.lit("Windows").alias("os"), F.lit("Browser").alias("app")))
    )
    actions = (
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("play"), F.lit("pause")))
        .when(F.col("o_orderstatus") == "O", F.array(F.lit("play"), F.lit("seek"), F.lit("like")))
        .otherwise(F.array(F.lit("play")))
    )
    return o.select(
        F.concat(F.lit("watch_"), _s("o_orderkey")).alias("session_id"),
        F.concat(F.lit("user_"), _s("o_custkey")).alias("user_id"),
        iso_text(start, off).alias("start_time"),
        iso_text(end, off).alias("end_time"),
        F.col("pages").alias("pages_visited"),
        device.alias("device"),
        actions.alias("actions"),
        _src(F.col("o_orderkey")).alias(SRC),
    )


# ---- SupportCases ← orders + lineitem ----------------------------------------


def support_case_docs(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One case per order; its lines are the messages (none: no messages)."""
    # The lines are shuffled on the order key as they are (a partial
    # collect_list would not shrink them); the message texts are built after
    # the shuffle, where the work is spread over the key partitions.
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").repartition("l_orderkey")
    msgs = lines.groupBy("l_orderkey").agg(
        F.transform(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.col("l_linenumber").alias("n"),
                        F.col("l_partkey").alias("p"),
                        F.struct(
                            F.when(F.col("l_linenumber") % 2 == 1, F.lit("user")).otherwise(F.lit("support")).alias("sender"),
                            F.concat(F.lit("line "), _s("l_linenumber"), F.lit(" part "), _s("l_partkey")).alias("message"),
                            iso_text(F.col("l_shipdate").cast("timestamp"), F.lit(0)).alias("timestamp"),
                        ).alias("m"),
                    )
                )
            ),
            lambda x: x["m"],
        ).alias("messages")
    )
    return _case_fields(orders.join(per_order(msgs), orders.o_orderkey == msgs.l_orderkey, "left"))


def _case_fields(o: DataFrame) -> DataFrame:
    created = _order_start(o)
    updated = created + F.make_dt_interval(hours=F.pmod(F.col("o_orderkey") * 13, F.lit(48)) + 1)
    status = (
        F.when((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("resolved"))
        .when(F.col("o_orderstatus") == "F", F.lit("closed"))
        .when(F.col("o_orderstatus") == "O", F.lit("open"))
        .otherwise(F.lit("in_progress"))
    )
    issue = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("billing"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("quality"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("access"))
        .otherwise(F.lit("other"))
    )
    off = order_offset()
    return o.select(
        F.concat(F.lit("case_"), _s("o_orderkey")).alias("ticket_id"),
        F.concat(F.lit("user_"), _s("o_custkey")).alias("user_id"),
        status.alias("status"),
        issue.alias("issue_type"),
        "messages",
        iso_text(created, off).alias("created_at"),
        iso_text(updated, off).alias("updated_at"),
        _src(F.col("o_orderkey")).alias(SRC),
    )


# ---- ContentRecommendations ← orders + lineitem -------------------------------


def recommendation_docs(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One document per order for its customer (so a user has several; the
    first in source order wins). Pending orders use the newer field name
    ``recommended_content``."""
    pages = per_order(order_pages(lineitem))
    o = orders.join(pages, orders.o_orderkey == pages.l_orderkey, "left")
    pending = F.col("o_orderstatus") == "P"
    return o.select(
        F.concat(F.lit("user_"), _s("o_custkey")).alias("user_id"),
        F.when(~pending, F.col("pages")).alias("recommended_products"),
        F.when(pending, F.col("pages")).alias("recommended_content"),
        iso_text(_order_start(o), order_offset()).alias("last_updated"),
        _src(F.col("o_orderkey")).alias(SRC),
    )


# ---- AbuseReports ← lineitem + orders ------------------------------------------


def abuse_report_docs(orders: DataFrame, lineitem: DataFrame, in_order: bool = False) -> DataFrame:
    """One report per line item, by the order's customer. (orderkey,
    linenumber) repeats in the data, so review ids repeat too; source order
    is the line's own columns. With ``in_order`` the lines of an order are in
    one partition and in source order."""
    own = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ]
    if in_order:  # an exchange that is asked for is never split for skew
        lineitem = lineitem.select(*own).repartition("l_orderkey")
    j = lineitem.join(per_order(orders.select("o_orderkey", "o_custkey")), lineitem.l_orderkey == orders.o_orderkey, "inner")
    if in_order:
        j = j.sortWithinPartitions(*own)
    flags = (
        F.when(F.col("l_returnflag") == "R", F.array(F.lit("spam_suspected")))
        .when(F.col("l_returnflag") == "A", F.array(F.lit("other"), F.lit("nudity")))
        .otherwise(F.array().cast("array<string>"))
    )
    status = (
        F.when(F.col("l_linestatus") == "O", F.lit("pending"))
        .when(F.col("l_returnflag") == "R", F.lit("rejected"))
        .otherwise(F.lit("approved"))
    )
    order = F.struct(
        F.lit("").alias("file"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("l_orderkey").alias("row"),
        *own[1:],
    )
    return j.select(
        F.concat(F.lit("abuse_"), _s("l_orderkey"), F.lit("_"), _s("l_linenumber")).alias("review_id"),
        F.concat(F.lit("user_"), _s("o_custkey")).alias("user_id"),
        F.concat(F.lit("vid_"), _s("l_partkey")).alias("product_id"),
        F.lit(None).cast("string").alias("object_id"),
        F.concat(F.lit("returned "), _s(F.col("l_quantity").cast("int")), F.lit(" of part "), _s("l_partkey")).alias("review_text"),
        (F.pmod(F.col("l_quantity").cast("int"), F.lit(5)) + 1).cast("int").alias("rating"),
        status.alias("moderation_status"),
        flags.alias("flags"),
        iso_text(F.col("l_shipdate").cast("timestamp"), F.lit(0)).alias("submitted_at"),
        order.alias(SRC),
    )


# ---- PlaybackEvents ← events ----------------------------------------------------


def event_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def playback_event_docs(events: DataFrame) -> DataFrame:
    quality = F.element_at(
        F.array(*[F.lit(q) for q in ("144p", "360p", "720p", "1080p")]), F.pmod(event_k(), F.lit(4)) + 1
    )
    off = F.when(F.col("event_type") == "error", F.lit(3)).otherwise(F.lit(0))
    return events.select(
        F.concat(F.lit("play_"), _s("event_id")).alias("event_id"),
        iso_text(F.col("ts").cast("timestamp"), off).alias("timestamp"),
        "event_type",
        F.struct(
            F.concat(F.lit("vid_"), _s("user_id")).alias("video_id"),
            F.floor(F.col("value") * 10).cast("int").alias("position_seconds"),
            quality.alias("quality"),
        ).alias("details"),
        _src(F.col("event_id")).alias(SRC),
    )


# ---- IoT temperature export ← events -------------------------------------------


def iot_readings(events: DataFrame, missing_ids: bool = False, bad_dates: bool = False) -> DataFrame:
    """The CSV export's columns, all text: a device per user, readings logged
    per hour, view and click readings indoor, error readings ``nan``.
    With ``missing_ids`` the signup readings come without a device id, with
    ``bad_dates`` every eleventh reading has a day that no month has."""
    dev = F.concat(F.lit("dev_"), _s("user_id"))
    if missing_ids:
        dev = F.when(F.col("event_type") != "signup", dev)
    return events.select(
        dev.alias("id"),
        F.lit("Room Admin").alias("room_id/id"),
        F.when(F.lit(bad_dates) & (F.pmod("event_id", F.lit(11)) == 4), F.date_format(F.col("ts"), "'32'-MM-yyyy HH:00"))
        .otherwise(F.date_format(F.col("ts"), "dd-MM-yyyy HH:00"))
        .alias("noted_date"),
        F.when(F.col("event_type") == "error", F.lit("nan"))
        .otherwise(_s(F.floor("value").cast("bigint")))
        .alias("temp"),
        F.when(F.col("event_type").isin("view", "click"), F.lit("In")).otherwise(F.lit("Out")).alias("out/in"),
        _src(F.col("event_id")).alias(SRC),
    )


# ---- JSON documents in a column ← conversations ---------------------------------

# documents hold at most this many turns of one conversation
TURNS_PER_DOC = 4


def pets_json_rows(conversations: DataFrame, cut: bool = False) -> DataFrame:
    """``raw_json(json_data)``: a turn is a pet; a document holds up to
    ``TURNS_PER_DOC`` turns of one conversation. System turns have an empty
    food list and a null birth year. With ``cut``, documents of every fifth
    conversation end before their last brace."""
    system = F.col("role") == "system"
    pet = F.struct(
        F.concat_ws("-", "role", _s("conv_id"), _s("turn")).alias("name"),
        F.col("role").alias("species"),
        F.when(system, F.array().cast("array<string>")).otherwise(F.split("text", "\n")).alias("favFoods"),
        F.when(~system, F.lit(2000) + F.col("turn")).alias("birthYear"),
        F.concat(F.lit("images/"), F.col("role"), F.lit("-"), _s("conv_id"), F.lit(".jpg")).alias("photo"),
    )
    docs = conversations.groupBy("conv_id", F.floor(F.col("turn") / TURNS_PER_DOC).alias("part")).agg(
        F.collect_list(pet).alias("pets")
    )
    text = F.to_json(F.struct("pets"))
    if cut:
        broken = F.pmod("conv_id", F.lit(5)) == 3
        text = F.when(broken, F.left(text, F.length(text) - 1)).otherwise(text)
    return docs.select(text.alias("json_data"))


# ---- XML documents in a column ← part ----------------------------------------------

# documents hold the foods of at most this many consecutive part keys
PARTS_PER_DOC = 8

# Fixed value: the reference document's header block, never read by the flattening.
DAILY_VALUES_XML = (
    "<daily-values>\n"
    '\t<total-fat units="g">65</total-fat>\n'
    '\t<saturated-fat units="g">20</saturated-fat>\n'
    '\t<cholesterol units="mg">300</cholesterol>\n'
    '\t<sodium units="mg">2400</sodium>\n'
    '\t<carb units="g">300</carb>\n'
    '\t<fiber units="g">25</fiber>\n'
    '\t<protein units="g">50</protein>\n'
    "</daily-values>"
)


def food_fields() -> dict[str, Column]:
    """The food of a part, as text values (shared with the oracle)."""
    size = F.col("p_size")
    return {
        "name": F.concat(F.col("p_name"), F.lit(", "), F.col("p_type"), F.when(size > 45, F.lit(" ")).otherwise(F.lit(""))),
        "mfr": F.col("p_brand"),
        "serving": _s(size),
        "cal_total": _s(size * 10),
        "cal_fat": F.when(F.col("p_type") == "SMALL", F.lit("")).otherwise(_s(size * 3)),
        "total-fat": _s(F.col("p_retailprice").cast("decimal(12,2)")),
        "saturated-fat": _s(F.pmod(size, F.lit(10))),
        "cholesterol": _s(F.pmod(F.col("p_partkey"), F.lit(300))),
        "sodium": _s(size * 20),
        "carb": _s(F.pmod(size, F.lit(30))),
        "fiber": _s(F.pmod(size, F.lit(5))),
        "protein": _s(F.pmod(size, F.lit(12))),
        "va": _s(F.pmod(size, F.lit(40))),
        "vc": _s(F.pmod(size, F.lit(50))),
        "ca": _s(F.pmod(size, F.lit(9))),
        "fe": _s(F.pmod(size, F.lit(21))),
    }


def _el(tag: str, value: Column) -> Column:
    return F.concat(F.lit(f"\t<{tag}>"), xml_escape(value), F.lit(f"</{tag}>\n"))


def foods_xml_rows(part: DataFrame, nested: bool = False, cut: bool = False) -> DataFrame:
    """``raw_xml(xml_data)``: a part is a food; economy parts have no
    vitamins, promo parts no minerals. With ``nested``, standard parts stand on
    shelves below the root, and small ones inside the food of the part before
    them in their document; with ``cut``, every seventh document ends early."""
    f = food_fields()
    vitamins = F.when(
        F.col("p_type") != "ECONOMY",
        F.concat(F.lit("\t<vitamins>\n\t"), _el("a", f["va"]), F.lit("\t"), _el("c", f["vc"]), F.lit("\t</vitamins>\n")),
    ).otherwise(F.lit(""))
    minerals = F.when(
        F.col("p_type") != "PROMO",
        F.concat(F.lit("\t<minerals>\n\t"), _el("ca", f["ca"]), F.lit("\t"), _el("fe", f["fe"]), F.lit("\t</minerals>\n")),
    ).otherwise(F.lit(""))
    food = F.concat(
        F.lit("<food>\n"),
        _el("name", f["name"]),
        _el("mfr", f["mfr"]),
        F.lit('\t<serving units="g">'), xml_escape(f["serving"]), F.lit("</serving>\n"),
        F.lit('\t<calories total="'), f["cal_total"], F.lit('" fat="'), f["cal_fat"], F.lit('"/>\n'),
        *[_el(t, f[t]) for t in ("total-fat", "saturated-fat", "cholesterol", "sodium", "carb", "fiber", "protein")],
        vitamins,
        minerals,
        F.lit("</food>"),
    )
    shelf = F.concat(F.lit("<aisle>\n<shelf>\n"), food, F.lit("\n</shelf>\n</aisle>"))
    kind = F.when(F.lit(nested) & (F.col("p_type") == "STANDARD"), "shelf").when(F.lit(nested) & (F.col("p_type") == "SMALL"), "inner")
    placed = F.struct("p_partkey", kind.alias("kind"), F.when(kind == "shelf", shelf).otherwise(food).alias("xml"))
    docs = part.groupBy(F.floor(F.col("p_partkey") / PARTS_PER_DOC).alias("chunk")).agg(F.array_sort(F.collect_list(placed)).alias("foods"))
    end = "</food>"
    # an inner food goes in before the end of what stands so far, if that is a food
    joined = F.aggregate(
        "foods",
        F.lit(""),
        lambda acc, x: F.when(
            (x["kind"] == "inner") & acc.endswith(end),
            F.concat(F.left(acc, F.length(acc) - len(end)), x["xml"], F.lit(end)),
        ).otherwise(F.concat(acc, F.when(acc != "", F.lit("\n")).otherwise(F.lit("")), x["xml"])),
    )
    whole = F.concat(
        F.lit('<?xml version="1.0"?>\n<nutrition>\n'), F.lit(DAILY_VALUES_XML), F.lit("\n"), joined, F.lit("\n</nutrition>\n")
    )
    if cut:
        whole = F.when(F.pmod("chunk", F.lit(7)) == 5, F.left(whole, F.length(whole) - 20)).otherwise(whole)
    return docs.select(whole.alias("xml_data"))
