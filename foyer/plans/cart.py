"""Cart rules over all carts at once.

``carts`` has one row per order; each rule adds columns to it or returns the
changes it proposes. Configuration values are scalar subqueries, so they need
neither a join nor a trip through the driver. Lines are made distinct per
(order, performance) or combined per key before they meet the carts, so an order
or a performance with a large share of the lines stays cheap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions import (
    add_hours,
    compose_message,
    gift_target,
    pretty_datetime,
    round_up_ask,
    route_action,
    same_text,
    split_csv,
)
from ..functions.dates import Moment, moment
from ..operators import (
    binned_date_join,
    by_either_key,
    earliest_per_key,
    elementary_pieces,
    fallback_pick,
    first_per_key,
    rule_lookup,
)
from ..streaming.runner import fold_stream

# --- configuration ----------------------------------------------------------


def _typed(content: DataFrame, kind: str) -> DataFrame:
    return content.where(same_text(F.col("content_type"), F.lit(kind)))


def setting(content: DataFrame, kind: str, column: str) -> Column:
    """One configuration value; NULL where it is missing, an error where it is there twice."""
    return _typed(content, kind).select(column).scalar()


def with_config(carts: DataFrame, content: DataFrame) -> DataFrame:
    """Add the modes of sale and price type groups the rules refer to."""
    return carts.withColumns(
        {
            "rules_mos": F.coalesce(setting(content, codes.CONTENT_RULES_MOS, "mos"), F.lit(0)),
            "matinee_mos": F.coalesce(setting(content, codes.CONTENT_MATINEE_MOS, "mos"), F.lit(0)),
            "package_mos": setting(content, codes.CONTENT_THREE_OR_MORE, "mos"),
            "package_group": setting(content, codes.CONTENT_THREE_OR_MORE, "price_type_group"),
            "single_group": setting(content, codes.CONTENT_LESS_THAN_THREE, "price_type_group"),
        }
    )


def _not_excluded(mos: Column, *modes: Column) -> Column:
    """Unless ``mos`` is surely none of ``modes``: with a NULL mode the rule still applies."""
    return F.coalesce(mos.isin(*modes), F.lit(True))


def _dated(content: DataFrame, kind: str) -> DataFrame:
    """Rows of a type in use with the ends of their validity; the last day counts up to its last hour."""
    start = F.coalesce(F.col("from_dt"), moment(codes.CONTENT_MIN))
    end = add_hours(F.coalesce(F.col("thru_dt"), moment(codes.CONTENT_MAX)), codes.CONTENT_LAST_DAY_HOURS)
    used = _typed(content, kind).where(F.coalesce(F.col("inactive"), F.lit("N")) != "Y")
    return used.withColumns({"_start": start, "_end": end})


def content_at(content: DataFrame, carts: DataFrame, kind: str, at: str, values: Sequence[str]) -> DataFrame:
    """Like :func:`active_content` with each cart's own moment ``at``.

    Rows for one mode of sale, and those for all, are cut into pieces of time
    with the row that applies in each; a cart finds one piece of either.
    """
    row = ["id", *[v for v in values if v != "id"]]
    dated = _dated(content, kind)
    keyed = carts.withColumns({"_mos": F.coalesce("mos", F.lit(0)), "_all": F.lit(0)})
    for key, rows in (("_mos", dated.where("mos IS NOT NULL")), ("_all", dated.where("mos IS NULL"))):
        rows = rows.withColumn(key, F.col("mos") if key == "_mos" else F.lit(0))
        pieces = elementary_pieces(rows, [key], row, "_start", "_end")
        named = pieces.select(key, "_start", "_end", F.struct(*row).alias(f"_row{key}"))
        keyed = binned_date_join(keyed, named, [key], at, "_start", "_end")
    own, shared = F.col("_row_mos"), F.col("_row_all")
    pick = F.when(own.id < shared.id, own).otherwise(F.coalesce(shared, own))
    return keyed.withColumn("_pick", pick).select(*carts.columns, *[F.col(f"_pick.{v}").alias(v) for v in values])


def active_content(
    content: DataFrame, carts: DataFrame, kind: str, as_of: Moment, values: Sequence[str]
) -> DataFrame:
    """Add the configuration row of a type that applies to each cart at ``as_of``.

    A row without mode of sale applies to every cart. The last day counts up to
    its last hour. Of several rows the one with the lowest id applies.
    """
    live = _dated(content, kind).where(moment(as_of).between(F.col("_start"), F.col("_end")))
    row = F.struct("id", *[v for v in values if v != "id"])
    for_all = live.where(F.col("mos").isNull()).agg(F.min(row).alias("r")).scalar()
    for_one = live.where(F.col("mos").isNotNull()).groupBy(F.col("mos").alias("_mos")).agg(
        F.min(row).alias("_own")
    )
    joined = carts.join(for_one, F.coalesce(carts["mos"], F.lit(0)) == F.col("_mos"), "left")
    picked = joined.withColumn("_any", for_all).withColumn(
        "_pick",
        F.when(F.col("_own.id") < F.col("_any.id"), F.col("_own")).otherwise(
            F.coalesce("_any", "_own")
        ),
    )
    return picked.select(*[carts[c] for c in carts.columns], *[F.col(f"_pick.{v}").alias(v) for v in values])


# --- context ----------------------------------------------------------------


def last_line_item(sub_lines: DataFrame) -> DataFrame:
    """Last line of each order: its number, highest codes and number of seats.

    Rows are combined per line first, so the second step sees one row per line.
    """
    seq = F.coalesce(F.col("li_seq_no"), F.lit(0)).alias("li_seq_no")
    per_line = sub_lines.groupBy("order_no", seq).agg(
        F.max("perf_no").alias("perf_no"),
        F.max("pkg_no").alias("pkg_no"),
        F.max("price_type").alias("price_type"),
        F.count(F.lit(1)).alias("seats"),
    )
    row = F.struct("li_seq_no", "perf_no", "pkg_no", "price_type", "seats")
    return per_line.groupBy("order_no").agg(F.max(row).alias("_row")).select("order_no", "_row.*")


def distinct_perfs(cart_lines: DataFrame) -> DataFrame:
    """Number of different performances per order."""
    return cart_lines.groupBy("order_no").agg(F.countDistinct("perf_no").alias("total_perfs"))


def keyword_perfs(perf: DataFrame, inv_tkw: DataFrame, rules: DataFrame) -> DataFrame:
    """Performances whose production season carries the keyword of a rule in use."""
    words = rules.where(F.col("inactive") != "Y").select(F.col("keyword").alias("tkw"))
    seasons = inv_tkw.join(words, "tkw", "left_semi").select(F.col("inv_no").alias("prod_season_no"))
    return perf.join(seasons, "prod_season_no", "left_semi").select("perf_no").distinct()


def perf_counts(cart_lines: DataFrame, marked: DataFrame) -> DataFrame:
    """Different performances and different marked performances per order, in one pass."""
    pairs = cart_lines.select("order_no", "perf_no").where(F.col("perf_no").isNotNull()).distinct()
    flagged = pairs.join(marked.withColumn("_marked", F.lit(1)), "perf_no", "left")
    return flagged.groupBy("order_no").agg(
        F.count("perf_no").alias("total_perfs"), F.count("_marked").alias("total_kwd_perfs")
    )


def distinct_keyword_perfs(
    cart_lines: DataFrame, perf: DataFrame, inv_tkw: DataFrame, rules: DataFrame
) -> DataFrame:
    """Number of different performances under an active rule keyword per order."""
    counts = perf_counts(cart_lines, keyword_perfs(perf, inv_tkw, rules))
    return counts.select("order_no", "total_kwd_perfs")


def logged_in(state: DataFrame, defaults: DataFrame) -> DataFrame:
    """``(sessionkey, logged_in)``: ``N`` only for the default login."""
    names = state.where(same_text(F.col("name"), F.lit(codes.VAR_USER_NAME)))
    user = names.groupBy("sessionkey").agg(F.min("value").alias("user_name"))
    default = defaults.agg(F.min("default_login").alias("d")).scalar()
    flag = F.when(same_text(F.col("user_name"), default), "N").otherwise("Y")
    return user.select("sessionkey", flag.alias("logged_in"))


def cart_context(
    web_order: DataFrame, web_session: DataFrame, state: DataFrame, defaults: DataFrame,
    sub_lines: DataFrame, cart_lines: DataFrame, marked: DataFrame,
) -> DataFrame:
    """One row per cart with session, last line item and show counts; 0 for what is missing."""
    zero = F.lit(0)
    session = web_session.select(
        "sessionkey",
        F.coalesce("mos", zero).alias("mos"),
        F.coalesce("originalmos", zero).alias("orig_mos"),
    )
    carts = web_order.select(
        "sessionkey",
        *[F.coalesce(c, zero).alias(c) for c in ("customer_no", "order_no", "source_no")],
        "order_total",
    ).join(session, "sessionkey")
    return (
        carts.join(logged_in(state, defaults), "sessionkey", "left")
        .join(last_line_item(sub_lines), "order_no", "left")
        .join(perf_counts(cart_lines, marked), "order_no", "left")
        .fillna({"logged_in": "Y", "seats": 0, "total_perfs": 0, "total_kwd_perfs": 0})
    )


# --- price types and modes of sale ------------------------------------------


def valid_price_type(
    perf_pmap: DataFrame, price_type: DataFrame, as_of: Moment, group: int | None = None
) -> DataFrame:
    """Lowest price type per performance and group that is valid at ``as_of``."""
    kinds = price_type.select(F.col("id").alias("price_type"), "price_type_group")
    if group is not None:
        kinds = kinds.where(F.col("price_type_group") == group)
    return (
        perf_pmap.where(moment(as_of).between(F.col("start_dt"), F.col("end_dt")))
        .select("perf_no", "price_type")
        .join(kinds, "price_type")
        .groupBy("perf_no", "price_type_group")
        .agg(F.min("price_type").alias("new_price_type"))
    )


def price_type_pieces(perf_pmap: DataFrame, price_type: DataFrame) -> DataFrame:
    """Lowest valid price type per performance and group, for each piece of time between the starts and ends of prices."""
    kinds = price_type.select(F.col("id").alias("price_type"), "price_type_group")
    rows = perf_pmap.select("perf_no", "price_type", "start_dt", "end_dt").join(kinds, "price_type")
    pieces = elementary_pieces(rows, ["perf_no", "price_type_group"], ["price_type"], "start_dt", "end_dt")
    return pieces.withColumnRenamed("price_type", "new_price_type")


def _package_scope() -> Column:
    """Carts the package rule looks at."""
    mos = F.col("mos")
    return _not_excluded(mos, F.col("rules_mos"), F.col("package_mos")) & (
        F.col("orig_mos") != F.col("matinee_mos")
    )


def _seen_keywords(everywhere: bool) -> Column:
    """Keyword shows as the rules after the package rule see them: not counted outside its carts."""
    count = F.col("total_kwd_perfs")
    return count if everywhere else F.when(_package_scope(), count)


def _lines_to_reprice(
    carts: DataFrame, sub_lines: DataFrame, price_type: DataFrame, content: DataFrame, also: Sequence[str] = ()
) -> DataFrame:
    """Lines of carts in scope whose price type is in one of the two groups, with the group they should be in."""
    scoped = with_config(carts, content).where(_package_scope())
    package = F.col("total_perfs") >= codes.SHOWS_FOR_PACKAGE
    wanted = F.when(package, F.col("package_group")).otherwise(F.col("single_group"))
    scoped = scoped.select("sessionkey", "order_no", "package_group", "single_group", wanted.alias("_wanted"), *also)
    kinds = price_type.select(
        F.col("id").alias("old_price_type"), F.col("price_type_group").alias("_group")
    )
    return (
        sub_lines.select("order_no", "sli_no", "perf_no", F.col("price_type").alias("old_price_type"))
        .join(kinds, "old_price_type")
        .join(scoped, "order_no")
        .where(F.col("_group").isin(F.col("package_group"), F.col("single_group")))
        .withColumn("price_type_group", F.coalesce("_wanted", "old_price_type"))
    )


def reprice_at(
    carts: DataFrame, sub_lines: DataFrame, perf_pmap: DataFrame, price_type: DataFrame,
    content: DataFrame, at: str,
) -> DataFrame:
    """Like :func:`reprice` with the prices valid at each cart's own moment ``at``."""
    lines = _lines_to_reprice(carts, sub_lines, price_type, content, [at])
    pieces = price_type_pieces(perf_pmap, price_type)
    found = binned_date_join(lines, pieces, ["perf_no", "price_type_group"], at, how="inner")
    return found.where(F.col("old_price_type") != F.col("new_price_type")).select(
        "sessionkey", "order_no", "sli_no", "old_price_type", "new_price_type"
    )


def reprice(
    carts: DataFrame, sub_lines: DataFrame, perf_pmap: DataFrame, price_type: DataFrame,
    content: DataFrame, as_of: Moment,
) -> DataFrame:
    """Price type changes: carts of three shows and more get the package group, others the single one.

    Only lines whose price type is in one of the two groups change, and only
    where the performance has a price type of the wanted group.
    """
    lines = _lines_to_reprice(carts, sub_lines, price_type, content)
    return (
        lines.join(valid_price_type(perf_pmap, price_type, as_of), ["perf_no", "price_type_group"])
        .where(F.col("old_price_type") != F.col("new_price_type"))
        .select("sessionkey", "order_no", "sli_no", "old_price_type", "new_price_type")
    )


def mos_change(carts: DataFrame, content: DataFrame, state: DataFrame) -> DataFrame:
    """Proposed changes of the mode of sale: to the package one, back, or to matinee."""
    before = (
        state.where(same_text(F.col("name"), F.lit(codes.VAR_MOS_CHANGED_FROM)))
        .groupBy("sessionkey")
        .agg(F.min(F.col("value").try_cast("int")).alias("_from"), F.lit(True).alias("_changed"))
    )
    rows = with_config(carts, content).join(before, "sessionkey", "left")
    mos, changed = F.col("mos"), F.col("_changed").isNotNull()
    many = F.col("total_perfs") >= codes.SHOWS_FOR_PACKAGE
    package = F.col("package_mos")
    to_package = _package_scope() & many & (F.coalesce(package, mos) != mos) & ~changed
    back = _package_scope() & ~many & (F.coalesce(package, F.lit(0)) == mos) & changed
    matinee = F.col("matinee_mos")
    to_matinee = (F.col("orig_mos") == matinee) & (mos != matinee) & ~changed
    new = F.when(to_package, package).when(back, F.col("_from")).when(to_matinee, matinee)
    return rows.select("sessionkey", mos.alias("old_mos"), new.alias("new_mos")).where(
        F.col("new_mos").isNotNull()
    )


def price_change_audit(history: DataFrame, changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """First original price type per session and line; later changes keep it."""
    return first_per_key(history, changes, ["sessionkey", "sli_no"], order)


def price_change_stream(
    history: DataFrame, changes: DataFrame, order: Sequence[str], out: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Like :func:`price_change_audit` with ``changes`` as a stream, drained into a stored table.

    The first price of a session and line is that of its earliest change by
    ``order``, however late it comes; a batch rewrites the buckets of its own
    sessions only.
    """
    keys = ["sessionkey", "sli_no"]
    values = [c for c in history.columns if c not in keys]

    def first(rows: DataFrame) -> DataFrame:
        return earliest_per_key(rows, keys, list(dict.fromkeys([*values, *order])), order)

    table = fold_stream(changes, first, first, ["sessionkey"], out, checkpoint)
    return price_change_audit(history, table.read(), order)


# --- pre-selected shows -----------------------------------------------------


def selection_rows(selection: DataFrame, keep_last: bool = False) -> DataFrame:
    """One row per session and selected number."""
    numbers = F.explode(split_csv(F.col("selection"), keep_last))
    return selection.select("sessionkey", numbers.alias("number")).distinct()


def match_selection(
    numbers: DataFrame, perf: DataFrame, prod_season: DataFrame, inventory: DataFrame
) -> DataFrame:
    """Selected numbers as performance numbers, and as production season numbers."""
    # All that a number may be, under that number: one exchange of the selected numbers serves both joins by it.
    as_perf = perf.select(F.col("perf_no").alias("number"), "prod_season_no", "perf_no", "perf_dt")
    # A season counts once it has a performance; its performances need not be listed.
    as_season = perf.select(
        F.col("prod_season_no").alias("number"), "prod_season_no",
        F.lit(None).cast("long").alias("perf_no"), F.lit(None).cast("timestamp_ntz").alias("perf_dt"),
    ).where("number IS NOT NULL").distinct()
    names = inventory.select(F.col("inv_no").alias("number"), F.col("description").alias("pds_desc"))
    seasons = prod_season.select("prod_season_no", F.col("prod_no").alias("pd_no"))
    return (
        numbers.join(as_perf.union(as_season), "number")
        .join(names, "number")
        .join(seasons, "prod_season_no")
        .select(
            "sessionkey", "pd_no", F.col("prod_season_no").alias("pds_no"), "perf_no", "pds_desc",
            "perf_dt",
        )
        .distinct()
    )


def in_cart_flag(items: DataFrame, web_order: DataFrame, cart_lines: DataFrame, perf: DataFrame) -> DataFrame:
    """``in_cart``: the item's performance, or one of its season if it has none, is in the cart."""
    bought = (
        cart_lines.select("order_no", "perf_no")
        .distinct()
        .join(web_order.select("order_no", "sessionkey"), "order_no")
        .join(perf.select("perf_no", F.col("prod_season_no").alias("pds_no")), "perf_no", "left")
    )
    return by_either_key(items, bought, ["sessionkey"], ["perf_no", "pds_no"], "in_cart")


def in_carts(items: DataFrame, web_order: DataFrame, carts: Mapping[str, DataFrame], perf: DataFrame) -> DataFrame:
    """One flag for each of several line tables: whether the item is in the cart as they show it.

    As :func:`in_cart_flag`, with all tables in one pass: lines are united under
    their flag and reduced to one row for each cart and show before any join.
    """
    flags = list(carts)
    united = None
    for name, lines in carts.items():
        marked = lines.select("order_no", "perf_no", *[F.lit(f == name).alias(f) for f in flags])
        united = marked if united is None else united.union(marked)
    either = [F.max(f).alias(f) for f in flags]
    shows = united.groupBy("order_no", "perf_no").agg(*either)
    bought = shows.join(web_order.select("order_no", "sessionkey"), "order_no").join(
        perf.select("perf_no", F.col("prod_season_no").alias("pds_no")), "perf_no", "left"
    )
    # Items go by their performance, or else by their season.
    listed = F.explode(
        F.array(*[F.struct(F.lit(n).alias("_nth"), F.col(k).alias("_key")) for n, k in enumerate(("perf_no", "pds_no"))])
    )
    known = bought.select("sessionkey", listed.alias("_t"), *flags).where("_t._key IS NOT NULL")
    known = known.groupBy("sessionkey", F.col("_t._nth").alias("_nth"), F.col("_t._key").alias("_key")).agg(*either)
    nth = F.when(F.col("perf_no").isNotNull(), 0).when(F.col("pds_no").isNotNull(), 1)
    keyed = items.withColumns({"_nth": nth, "_key": F.coalesce("perf_no", "pds_no")})
    found = keyed.join(known, ["sessionkey", "_nth", "_key"], "left")
    return found.select(*items.columns, *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in flags])


def preselected_items(
    selection: DataFrame, perf: DataFrame, prod_season: DataFrame, inventory: DataFrame,
    web_order: DataFrame, lines_before: DataFrame, lines_now: DataFrame, keep_last: bool = False,
) -> DataFrame:
    """:func:`preselected` by the lines at the time of the selection, marked as by :func:`mark_processed` by those of now."""
    items = match_selection(selection_rows(selection, keep_last), perf, prod_season, inventory)
    flagged = in_carts(items, web_order, {"_before": lines_before, "_now": lines_now}, perf).where(~F.col("_before"))
    return flagged.select(*items.columns, _label(), F.when(F.col("_now"), "Y").otherwise("N").alias("processed"))


def _label() -> Column:
    when = F.coalesce(F.concat(F.lit(" - "), pretty_datetime(F.col("perf_dt"))), F.lit(""))
    return F.concat(F.col("pds_desc"), when).alias("label")


def preselected(
    selection: DataFrame, perf: DataFrame, prod_season: DataFrame, inventory: DataFrame,
    web_order: DataFrame, cart_lines: DataFrame, keep_last: bool = False,
) -> DataFrame:
    """Selected shows that are not in the cart, with their label; none is processed yet."""
    items = match_selection(selection_rows(selection, keep_last), perf, prod_season, inventory)
    still_open = in_carts(items, web_order, {"in_cart": cart_lines}, perf).where(~F.col("in_cart"))
    return still_open.select(*items.columns, _label(), F.lit("N").alias("processed"))


def mark_processed(
    items: DataFrame, web_order: DataFrame, cart_lines: DataFrame, perf: DataFrame
) -> DataFrame:
    """Mark the pre-selected shows that are in the cart by now."""
    flagged = in_cart_flag(items, web_order, cart_lines, perf)
    done = F.when(F.col("in_cart"), "Y").otherwise(F.col("processed"))
    return flagged.withColumn("processed", done).select(*items.columns)


def selection_texts(
    content: DataFrame, carts: DataFrame, as_of: Moment | None = None, at: str | None = None
) -> DataFrame:
    """Button, message and closing text of the selection page, with defaults; at one moment or at each cart's own."""
    texts = ["button_text", "long_text", "short_text"]
    if at is not None:
        found = content_at(content, carts, codes.CONTENT_PRESELECTED, at, texts)
    else:
        found = active_content(content, carts, codes.CONTENT_PRESELECTED, as_of, texts)
    return found.fillna(
        {
            "button_text": codes.DEFAULT_SELECT_BUTTON,
            "long_text": codes.DEFAULT_SELECT_MESSAGE,
            "short_text": codes.DEFAULT_SELECT_DONE,
        }
    )


def content_fallback(items: DataFrame, inv_content: DataFrame) -> DataFrame:
    """Image and synopsis of each item, from its season or else its production."""
    season, production = "pds_no", "pd_no"
    return fallback_pick(
        items,
        inv_content,
        {
            "image": [
                (season, codes.INV_PRODUCTION_IMAGE),
                (season, codes.INV_SEASON_IMAGE),
                (production, codes.INV_PRODUCTION_IMAGE),
                (season, codes.INV_CALENDAR_IMAGE),
            ],
            "synopsis": [(season, codes.INV_SYNOPSIS), (production, codes.INV_SYNOPSIS)],
        },
    )


# --- messages ---------------------------------------------------------------


def message_rule(carts: DataFrame, rules: DataFrame, keywords: Column | None = None) -> DataFrame:
    """Add text and checkout flag of the rule for the cart's two show counts; a missing count is 0."""
    keywords = F.col("total_kwd_perfs") if keywords is None else keywords
    live = rules.where(F.col("inactive") != "Y")
    found = rule_lookup(
        carts.withColumns(
            {"_kwd": F.coalesce(keywords, F.lit(0)), "_all": F.coalesce("total_perfs", F.lit(0))}
        ),
        live.select(
            "num_perfs_kwd", "num_perfs_total", "id",
            F.coalesce("message_text", F.lit("")).alias("message_text"),
            F.coalesce("disable_checkout", F.lit("N")).alias("disable_checkout"),
        ),
        {"_kwd": "num_perfs_kwd", "_all": "num_perfs_total"},
        ["id", "message_text", "disable_checkout"],
    )
    return found.select(*carts.columns, "message_text", "disable_checkout")


def cart_message(
    carts: DataFrame, rules: DataFrame, content: DataFrame, items: DataFrame | None = None,
    header: str = "", keywords_everywhere: bool = False,
) -> DataFrame:
    """Message of each cart in scope and whether it stops the checkout; no rule, no message.

    Carts with pre-selected shows still open are not told to go on shopping. In
    carts the package rule passes over, matinee ones above all, keyword shows
    count as none, unless ``keywords_everywhere``.
    """
    scoped = with_config(carts, content).where(
        _not_excluded(F.col("mos"), F.col("rules_mos"), F.col("package_mos"))
    )
    found = message_rule(scoped, rules, _seen_keywords(keywords_everywhere))
    waiting = F.lit(False)
    if items is not None:
        still_open = items.where(F.col("processed") == "N").select("sessionkey").distinct()
        found = found.join(still_open.withColumn("_open", F.lit(True)), "sessionkey", "left")
        waiting = F.col("_open").isNotNull()
    blocked = F.coalesce(F.col("disable_checkout"), F.lit("N")) == "Y"

    def text(kind: str, column: str, default: Column | str) -> Column:
        fallback = default if isinstance(default, Column) else F.lit(default)
        return F.coalesce(setting(content, kind, column), fallback)

    hint = F.when(blocked, codes.DEFAULT_CONTINUE_TEXT_BLOCKED).otherwise(codes.DEFAULT_CONTINUE_TEXT)
    go_on = F.when(
        ~waiting,
        compose_message(
            "\n",
            text(codes.CONTENT_CONTINUE, "button_text", codes.DEFAULT_CONTINUE_BUTTON),
            " ",
            text(codes.CONTENT_CONTINUE, "short_text", hint),
        ),
    ).otherwise("")
    finish = F.when(
        ~blocked,
        compose_message(
            "\n",
            text(codes.CONTENT_FINISHED, "button_text", codes.DEFAULT_FINISHED_BUTTON),
            " ",
            text(codes.CONTENT_FINISHED, "short_text", codes.DEFAULT_FINISHED_TEXT),
        ),
    ).otherwise("")
    return found.select(
        "sessionkey", "order_no",
        compose_message(header, F.col("message_text"), go_on, finish).alias("message"),
        F.when(blocked, "Y").otherwise("N").alias("disable_checkout"),
    )


def checkout_blocked(
    carts: DataFrame, content: DataFrame, keywords_everywhere: bool = False
) -> DataFrame:
    """Carts that may not check out: in scope, not all keyword shows, fewer than three shows.

    Keyword shows release only carts the package rule looks at; a matinee cart
    of one or two of them is stopped, unless ``keywords_everywhere``.
    """
    rows = with_config(carts, content)
    in_scope = _not_excluded(F.col("mos"), F.col("rules_mos"), F.col("matinee_mos"))
    seen = _seen_keywords(keywords_everywhere)
    all_keyword = F.coalesce(seen == F.col("total_perfs"), F.lit(False))
    few = F.coalesce("total_perfs", F.lit(0)) < codes.SHOWS_FOR_PACKAGE
    return rows.where(in_scope & ~all_keyword & few).select(
        "sessionkey", "order_no", "total_perfs",
        setting(content, codes.CONTENT_LIMIT_MESSAGE, "long_text").alias("message"),
    )


# --- gifts ------------------------------------------------------------------


def ask_eligible(
    carts: DataFrame, content: DataFrame, const_cust: DataFrame, state: DataFrame,
    contributions: DataFrame,
) -> DataFrame:
    """Carts to ask for a gift.

    The ask must be configured and in use; customers of the excluded
    constituency, sessions asked twice and carts with a gift are left out.
    """
    ask = _typed(content, codes.CONTENT_ROUND_UP)
    offered = ask.agg(
        ((F.count(F.lit(1)) > 0) & (F.count_if(F.col("inactive") == "Y") == 0)).alias("on")
    ).scalar()
    excluded = const_cust.where(
        F.col("constituency") == setting(content, codes.CONTENT_ROUND_UP, "constituency")
    ).select("customer_no")
    asked = state.where(
        same_text(F.col("name"), F.lit(codes.VAR_GIFT_ASKED)) & (F.rtrim("value") == "2")
    ).select("sessionkey")
    return (
        carts.where(offered)
        .join(excluded, "customer_no", "left_anti")
        .join(asked, "sessionkey", "left_anti")
        .join(contributions.select("order_no"), "order_no", "left_anti")
    )


def gift_ask(carts: DataFrame) -> DataFrame:
    """Gift and rounded cart total of each cart."""
    total = F.col("order_total")
    return carts.select(
        "sessionkey", "order_no", "order_total",
        round_up_ask(total).alias("ask"),
        gift_target(total).alias("target"),
    )


def gift_label(asks: DataFrame, content: DataFrame) -> DataFrame:
    """Text of the gift button, such as ``Round Up Your Order to $800``."""
    label = F.coalesce(
        setting(content, codes.CONTENT_ROUND_UP, "button_text"), F.lit(codes.DEFAULT_GIFT_LABEL)
    )
    return asks.withColumn("label", F.concat(label, F.lit(" $"), F.col("target").cast("string")))


def round_up_state(asks: DataFrame) -> DataFrame:
    """The session variable that remembers each ask; it replaces an older one."""
    return asks.select(
        "sessionkey", F.lit(codes.VAR_ROUND_UP).alias("name"),
        F.col("ask").cast("decimal(19,2)").cast("string").alias("value"),
    )


def route_and_decode(actions: DataFrame, state: DataFrame, content: DataFrame) -> DataFrame:
    """Every action with its module, and the amount where it carries a gift.

    One amount stands for the remembered ask. Amounts out of range, and all
    amounts while no fund is configured, are not accepted (NULL).
    """
    asked = (
        state.where(same_text(F.col("name"), F.lit(codes.VAR_ROUND_UP)))
        .groupBy("sessionkey")
        .agg(F.min(F.col("value").try_cast("decimal(19,4)")).alias("_stored"))
    )
    fund = _typed(content, codes.CONTENT_ROUND_UP).agg(F.max("value").alias("f")).scalar()
    given = F.col("code") - F.lit(codes.ACTION_GIFT)
    amount = F.when(given == codes.GIFT_USE_STORED, F.col("_stored")).otherwise(
        given.cast("decimal(19,4)")
    )
    gift = F.col("action") == "add_contribution"
    accepted = gift & amount.between(codes.GIFT_MIN, codes.GIFT_MAX) & F.col("fund").isNotNull()
    return (
        actions.withColumn("action", route_action(F.col("code")))
        .join(asked, "sessionkey", "left")
        .withColumn("fund", fund)
        .select(*actions.columns, "action", F.when(accepted, amount).alias("amount"))
    )


def decode_gift(actions: DataFrame, state: DataFrame, content: DataFrame) -> DataFrame:
    """The actions that carry a gift, with its amount."""
    routed = route_and_decode(actions, state, content)
    return routed.where(F.col("action") == "add_contribution").drop("action")


# --- session state ------------------------------------------------------------
#
# Rows (sessionkey, name, value) for ``apply_changes``; a NULL value deletes the variable.


def _having(state: DataFrame, name: str) -> DataFrame:
    """The sessions that have a variable."""
    return state.where(same_text(F.col("name"), F.lit(name))).select("sessionkey").distinct()


def mos_changed_state(changes: DataFrame, state: DataFrame) -> DataFrame:
    """The mode of sale that a first change left, from the changes of :func:`mos_change`."""
    new = changes.join(_having(state, codes.VAR_MOS_CHANGED_FROM), "sessionkey", "left_anti")
    value = F.col("old_mos").cast("string").alias("value")
    return new.select("sessionkey", F.lit(codes.VAR_MOS_CHANGED_FROM).alias("name"), value)


def gift_asked_state(eligible: DataFrame, state: DataFrame) -> DataFrame:
    """One for the first ask of a session, two from the second on."""
    asked = _having(state, codes.VAR_GIFT_ASKED).withColumn("_asked", F.lit(True))
    value = F.when(F.col("_asked"), codes.ASKED_FOR_GOOD).otherwise(codes.ASKED_ONCE).alias("value")
    sessions = eligible.select("sessionkey").distinct().join(asked, "sessionkey", "left")
    return sessions.select("sessionkey", F.lit(codes.VAR_GIFT_ASKED).alias("name"), value)


def gift_given_state(gifts: DataFrame, state: DataFrame) -> DataFrame:
    """Sessions that were asked and gave are not asked again."""
    given = gifts.where(F.col("amount").isNotNull()).select("sessionkey").distinct()
    asked = _having(state, codes.VAR_GIFT_ASKED).join(given, "sessionkey", "left_semi")
    return asked.select(
        "sessionkey", F.lit(codes.VAR_GIFT_ASKED).alias("name"), F.lit(codes.ASKED_FOR_GOOD).alias("value")
    )


def preselected_loop_state(items: DataFrame, state: DataFrame) -> DataFrame:
    """The loop over pre-selected shows begins where some are open, and ends where none is left."""
    waiting = items.where(F.col("processed") == "N").select("sessionkey").distinct()
    looping = _having(state, codes.VAR_PRESELECTED_LOOP)
    begun = waiting.join(looping, "sessionkey", "left_anti").withColumn("value", F.lit(codes.LOOP_ACTIVE))
    ended = looping.join(waiting, "sessionkey", "left_anti").withColumn("value", F.lit(None).cast("string"))
    return begun.union(ended).select("sessionkey", F.lit(codes.VAR_PRESELECTED_LOOP).alias("name"), "value")


def preselected_finished_state(carts: DataFrame, state: DataFrame) -> DataFrame:
    """The mark that a session has ended the selection at its last line item, where it has none."""
    name = F.concat(F.lit(codes.VAR_PRESELECTED_FINISHED), F.col("li_seq_no").cast("string"))
    rows = carts.where(F.col("li_seq_no").isNotNull()).select("sessionkey", name.alias("name"))
    known = state.select("sessionkey", F.col("name").alias("_name")).distinct()
    same = (rows["sessionkey"] == known["sessionkey"]) & same_text(F.col("name"), F.col("_name"))
    return rows.join(known, same, "left_anti").withColumn("value", F.lit(codes.LOOP_FINISHED))
