"""The marts' operators on the benchmark tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame that
reproduces one mart's pattern on the TPC-H-like tables, so it can be checked
against an independent SQL engine (``litreflow.plans.oracle``) and timed.
The mapping from mart to benchmark tables is given per function.

Outputs avoid values whose result depends on evaluation order or on the
binary representation of decimal ties: money is summed as decimals, and
rounded quotients are computed in integer arithmetic (``half_up_ratio``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litreflow.functions import (
    calendar_day_diff,
    flag_is_false,
    greater_or_second,
    half_up_ratio,
    is_after,
    spread_null_ids,
    substitute_key,
    zero_fallback,
)
from litreflow.functions.scalar import end_of_snapped_day, snap_to_day
from litreflow.operators import (
    collect_and_flag,
    conditional_pivot,
    existence_flag,
    latest_per_key,
    newest_valid,
    settlement_date,
    two_sided_ledger,
    union_with_typed_nulls,
    validity_join,
)
from litreflow.sources import DriverTables
from litreflow.sources.tables import tables_for

# --- fixed values of the benchmark mapping ---------------------------------
NIL_KEY = -1                       # integer stand-in for the nil GUID
HISTORY_FROM = "1998-01-01"        # history projection lower bound (>=)
ORDERS_FROM = "1996-01-01"         # deduped orders lower bound (>=)
PAYMENTS_AFTER = "1999-01-01"      # payment dates filter (strict >)
NEW_BUSINESS = "2001-01-01"        # new-business threshold (>=)
CODES_AS_OF = "2024-01-20 00:00:00"  # "now" of the active-codes view
VALIDITY_BUCKET_DAYS = 60
# --- end of fixed values -----------------------------------------------------


def _t(spark: SparkSession, sf_dir: str) -> DriverTables:
    return tables_for(spark, sf_dir)


# Projection of the transaction history from a date on.
def history_projection(spark, sf_dir) -> DataFrame:
    li = _t(spark, sf_dir).lineitem
    return (li.filter(is_after("l_shipdate", HISTORY_FROM))
            .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"))


# Vehicle x tank size -> greater-of capacity with asymmetric NULLs.
# supplier = vehicle, nation = tank-size table; configured size is NULL for a
# negative balance, calculated size is NULL in region 0.
def greater_of_capacity(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    j = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    configured = F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal"))
    calculated = F.when(F.col("n_regionkey") != 0,
                        F.col("n_regionkey").cast("double") * F.lit(2000.0))
    return (j.select("s_suppkey", "s_name", F.col("n_name").alias("nation"),
                     configured.alias("configured"), calculated.alias("calculated"))
            .withColumn("max_observed_capacity",
                        greater_or_second("calculated", "configured")))


def _daily_transactions(t: DriverTables, since=None, until=None) -> DataFrame:
    """lineitem as fuel transactions: the order's customer is the account,
    the supplier is the site; the provider is the supplier on 'F' lines
    (NULL for supplier 0) and the nil key otherwise. ``since``/``until``
    keep ship days in [since, until), filtered on the raw timestamp so the
    bounds reach the Parquet scan."""
    li, o = t.lineitem, t.orders
    if since is not None:
        li = li.filter(F.col("l_shipdate") >= F.lit(since).cast("date").cast("timestamp_ntz"))
    if until is not None:
        li = li.filter(F.col("l_shipdate") < F.lit(until).cast("date").cast("timestamp_ntz"))
    provider = (F.when(F.col("l_linestatus") == "F",
                       F.when(F.col("l_suppkey") != 0, F.col("l_suppkey")))
                .otherwise(F.lit(NIL_KEY).cast("long")))
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.to_date("l_shipdate").alias("ship_date"),
                    F.col("o_custkey").alias("customer_id"),
                    provider.alias("provider_id"),
                    F.col("l_suppkey").alias("supply_site_id"),
                    "l_quantity",
                    (F.col("l_returnflag") == "R").alias("reversed")))


def daily_quantity_from(tx: DataFrame, t: DriverTables) -> DataFrame:
    """M05 body: litres per day, customer, provider and site, titled by the
    site and by the *substituted* customer (provider unless nil)."""
    key = substitute_key("provider_id", "customer_id", nil=NIL_KEY)
    groups = ["ship_date", "customer_id", "provider_id", "supply_site_id"]
    # Aggregate on ids first (partial aggregation on the map side), then
    # attach titles to the much smaller aggregate.
    pre = (tx.filter(flag_is_false("reversed"))
           .groupBy(*groups, key.alias("customer_key"))
           .agg(F.sum("l_quantity").alias("litres")))
    # A title that n dimension rows share counts its litres n times: equal to
    # grouping the joined rows again, without the group-by.
    site = t.supplier.groupBy(F.col("s_suppkey").alias("supply_site_id"),
                              F.col("s_name").alias("depot")).agg(F.count(F.lit(1)).alias("n_site"))
    cust = t.customer.groupBy(F.col("c_custkey").alias("customer_key"),
                              F.col("c_name").alias("customer")).agg(F.count(F.lit(1)).alias("n_cust"))
    titled = pre.join(site, "supply_site_id").join(cust, "customer_key")
    return titled.select(*groups, "depot", "customer",
                         (F.col("litres") * F.col("n_site") * F.col("n_cust")).alias("litres"))


# Daily litres, joined on the CASE key, full load.
def daily_quantity(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    return daily_quantity_from(_daily_transactions(t), t)


# Orders + items (2-key left join) + customer + nation, one row per
# 6-key group ordered by the date that is itself a key (every row ties).
def deduped_orders(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    o, li, c, n = t.orders, t.lineitem, t.customer, t.nation
    # the customer's nation and the customer first, the items' fan-out last
    owner = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    j = (o.filter(is_after("o_orderdate", ORDERS_FROM))
         .join(owner, F.col("o_custkey") == F.col("c_custkey"), "left")
         .join(li, (F.col("o_orderkey") == F.col("l_orderkey"))
               & (F.col("o_orderstatus") == F.col("l_linestatus")), "left")
         .select("o_orderkey", "l_linenumber", "o_orderdate", "l_partkey", "l_suppkey",
                 F.col("c_name").alias("customer_name"), F.col("n_name").alias("nation_name"),
                 "o_orderpriority", "l_quantity", "l_extendedprice", "l_shipdate"))
    keys = ["o_orderkey", "l_linenumber", "o_orderdate", "l_partkey", "l_suppkey",
            "customer_name"]
    return latest_per_key(j, keys, [F.col("o_orderdate").desc()])


def _codes(t: DriverTables) -> DataFrame:
    """events as authorisation codes: captured at ts, valid floor(value)
    hours; the user is both the driver and the card."""
    e = t.events
    return e.select(F.col("event_id").cast("string").alias("code"),
                    F.col("user_id").cast("string").alias("driver_id"),
                    F.col("user_id").alias("card_id"),
                    F.col("user_id").cast("string").alias("code_customer_id"),
                    F.col("ts").alias("captured"),
                    F.timestamp_add("HOUR", F.floor("value").cast("int"), F.col("ts"))
                    .alias("expiry"))


# Newest valid code per driver, and per vehicle through its cards,
# as one union with typed NULLs.
def active_codes(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    now = F.lit(CODES_AS_OF).cast("timestamp_ntz")
    codes = _codes(t)
    valid = codes.filter((F.col("expiry") > now) & (F.col("captured") < now))
    per_driver = latest_per_key(valid, ["driver_id"],
                                [F.col("expiry").desc(), F.col("captured").desc()],
                                [F.col("code").asc()])
    a = per_driver.select(F.col("driver_id").alias("DriverID"),
                          F.col("expiry").alias("ExpiryDate"),
                          F.col("code").alias("CurrentVirtualCardNumber"),
                          F.lit("Driver").alias("LinkType"))
    # customer as card authorisations: vehicle = nation, card = customer key
    auth = t.customer.select(F.col("c_nationkey").cast("string").alias("vehicle_id"),
                             F.col("c_custkey").alias("auth_card_id"))
    newest = [F.col("captured").desc(), F.col("expiry").desc()]
    # one code per card before the authorisations fan out
    per_card = latest_per_key(valid, ["card_id"], newest, [F.col("code").asc()])
    joined = auth.join(per_card, F.col("auth_card_id") == F.col("card_id"))
    per_vehicle = latest_per_key(joined, ["vehicle_id"], newest,
                                 [F.col("code").asc(), F.col("auth_card_id").asc()])
    b = per_vehicle.select(F.col("vehicle_id").alias("VehicleID"),
                           F.col("code").alias("CurrentVirtualCardNumber"),
                           F.col("auth_card_id").cast("string").alias("CardID"),
                           F.col("code_customer_id").alias("CustomerID"),
                           F.col("expiry").alias("ExpiryDate"),
                           F.lit("Card_Vehicle").alias("LinkType"))
    cols = [("DriverID", "string"), ("VehicleID", "string"), ("ExpiryDate", "timestamp_ntz"),
            ("CardID", "string"), ("CustomerID", "string"),
            ("CurrentVirtualCardNumber", "string"), ("LinkType", "string")]
    return union_with_typed_nulls([a, b], cols)


# The enriched fact: a left-join star, newest order per customer as the
# "program" (existence flag, threshold flag), promotions pre-summed on the
# 3-key (day, site, product) join, a default label for a missing funder.
def enriched_fact(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    li, o, c, n, r, p, s = (t.lineitem, t.orders, t.customer, t.nation, t.region,
                            t.part, t.supplier)
    latest = latest_per_key(
        o.select(F.col("o_custkey").alias("ncp_custkey"),
                 F.col("o_orderdate").alias("date_active"),
                 F.col("o_orderpriority").alias("ncp_priority"),
                 F.col("o_orderkey").alias("ncp_orderkey")),
        ["ncp_custkey"], [F.col("date_active").desc()], [F.col("ncp_orderkey").desc()])
    promos = (li.groupBy(F.to_date("l_shipdate").alias("promo_date"),
                         F.col("l_suppkey").alias("promo_supp"),
                         F.col("l_partkey").alias("promo_part"))
              .agg(F.sum(F.col("l_discount").cast("decimal(12,2)")).alias("sd"),
                   F.sum(F.col("l_tax").cast("decimal(12,2)")).alias("td")))
    funder = s.select(F.col("s_suppkey").alias("funder_key"), F.col("s_name").alias("funder_name"))
    fact = li.withColumn("ship_date", F.to_date("l_shipdate")).withColumn(
        "funder_id", F.when(F.col("l_returnflag") == "N", F.col("l_suppkey")))
    # Lookups hang on their own parent: nation and region on the customer,
    # customer and newest order on the order. The fact is shuffled once per
    # own key, the keys that add the least to its rows first: promotion, part,
    # funder, order.
    places = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    owners = (c.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
              .join(latest, F.col("c_custkey") == F.col("ncp_custkey"), "left"))
    ordered = o.join(owners, F.col("o_custkey") == F.col("c_custkey"), "left")
    j = (fact
         .join(promos, (F.col("ship_date") == F.col("promo_date"))
               & (F.col("l_suppkey") == F.col("promo_supp"))
               & (F.col("l_partkey") == F.col("promo_part")), "left")
         .join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
         .join(funder, (spread_null_ids("funder_id", "l_orderkey", "l_linenumber") == F.col("funder_key"))
               & F.col("funder_id").isNotNull(), "left")
         .join(ordered, F.col("l_orderkey") == F.col("o_orderkey"), "left"))
    return j.select(
        "ship_date", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("c_name").alias("customer"), F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("nation"), F.col("r_name").alias("region"),
        F.coalesce(F.col("funder_name"), F.lit("Self-Funded")).alias("funder_type"),
        F.col("p_name").alias("product"), F.col("p_type").alias("product_type"),
        F.col("l_quantity").alias("litres"), F.col("l_extendedprice").alias("amount"),
        F.col("ncp_custkey").isNotNull().alias("ncp"),
        "ncp_priority", "date_active",
        F.coalesce(F.col("date_active") >= F.lit(NEW_BUSINESS).cast("timestamp_ntz"),
                   F.lit(False)).alias("new_business"),
        F.col("sd").cast("decimal(18,2)").alias("supplier_discount"),
        F.col("td").cast("decimal(18,2)").alias("tfn_discount"))


def _linked_payments(t: DriverTables) -> DataFrame:
    """lineitem rows as links of an order: 'R' = Payment, 'A' = Allocation,
    others Interest; line 1 links the nil entry, line 2 of an 'F' line has
    no link, other lines link the order numbered by the part key, whose
    total and date are the entry's amount and captured date."""
    li, o = t.lineitem, t.orders
    kind = (F.when(F.col("l_returnflag") == "R", F.lit("Payment"))
            .when(F.col("l_returnflag") == "A", F.lit("Allocation"))
            .otherwise(F.lit("Interest")))
    txn = (F.when(F.col("l_linenumber") == 1, F.lit(NIL_KEY).cast("long"))
           .when((F.col("l_linenumber") == 2) & (F.col("l_linestatus") == "F"),
                 F.lit(None).cast("long"))
           .otherwise(F.col("l_partkey")))
    links = li.select(F.col("l_orderkey").alias("order_key"), kind.alias("kind"),
                      txn.alias("txn_id"), F.col("l_shipdate").alias("txn_date"),
                      F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate"))
                      .alias("captured"))
    entries = o.select(F.col("o_orderkey").alias("entry_id"),
                       F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
                       F.col("o_orderdate").alias("entry_captured"))
    # the nil entry matches nothing and may be the most frequent id: spread
    known = F.col("txn_id").isNotNull() & (F.col("txn_id") != NIL_KEY)
    key = spread_null_ids(F.when(known, F.col("txn_id")), "order_key", "captured")
    return links.join(entries, (key == F.col("entry_id")) & known, "left")


# Settlement date per order; one pass with conditional aggregates.
def payment_dates(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    inv = t.orders.select(F.col("o_orderkey").alias("order_key"),
                          F.col("o_orderpriority").alias("buyer_order"),
                          F.col("o_totalprice").cast("decimal(18,2)").alias("invoice_amount"),
                          F.col("o_orderdate").alias("order_captured"))
    out = settlement_date(inv, _linked_payments(t), key="order_key",
                          invoice_amount="invoice_amount", kind="kind", amount="amount",
                          txn_id="txn_id", txn_date="txn_date", captured="captured",
                          entry_captured="entry_captured", nil=NIL_KEY,
                          paid_name="total_paid", date_name="payment_date")
    return (out.filter(is_after("order_captured", PAYMENTS_AFTER, inclusive=False))
            .select("order_key", "buyer_order", "invoice_amount",
                    F.col("total_paid").cast("decimal(18,2)").alias("total_paid"),
                    "payment_date", "order_captured"))


def _price_bands(t: DriverTables) -> DataFrame:
    """Price bands from orders, per customer: valid from the order date for
    floor(total / 1000) days (minus one second); open orders ('O') are
    open-ended (EffectiveTo = 1900-01-01). Bands may overlap."""
    o = t.orders
    days = F.floor(F.col("o_totalprice") / F.lit(1000.0)).cast("int")
    eff_to = F.when(F.col("o_orderstatus") == "O", F.lit("1900-01-01").cast("timestamp_ntz")) \
        .otherwise(F.timestamp_add("DAY", days, F.col("o_orderdate")) - F.expr("INTERVAL 1 SECOND"))
    return o.select(F.col("o_custkey").alias("band_cust"),
                    F.col("o_orderkey").alias("band_order"),
                    F.col("o_orderdate").alias("eff_from"),
                    eff_to.alias("eff_to"),
                    F.col("o_totalprice").alias("rebate"))


def _line_points(t: DriverTables) -> DataFrame:
    li, o = t.lineitem, t.orders
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .select("l_orderkey", "l_linenumber", F.col("o_custkey").alias("cust"),
                    "l_shipdate"))


def _open():
    return F.col("eff_to") == F.lit("1900-01-01").cast("timestamp_ntz")


# Validity join, raw bounds, strict '>' on the open-ended branch.
def validity_price_open(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    return validity_join(_line_points(t), _price_bands(t), [("cust", "band_cust")],
                         at="l_shipdate", lower=F.col("eff_from"), upper=F.col("eff_to"),
                         is_open=_open(), open_inclusive=False,
                         bucket_days=VALIDITY_BUCKET_DAYS).drop("cust", "band_cust")


# J11 + J12: day-snapped bounds, '>=' on the open-ended branch, newest band
# per line.
def validity_price_closed(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    best = newest_valid(_line_points(t), _price_bands(t), [("cust", "band_cust")],
                        ["l_orderkey", "l_linenumber"], at="l_shipdate", lower=F.col("eff_from"),
                        upper=end_of_snapped_day("eff_to"), is_open=_open(),
                        newest=["eff_from", "band_order"], open_lower=snap_to_day("eff_from"),
                        open_inclusive=True, bucket_days=VALIDITY_BUCKET_DAYS)
    return best.select("l_orderkey", "l_linenumber", "band_order", "eff_from", "rebate")


# Loads x every vehicle of their transporter (bounded fan-out: a region
# has five nations).
def loads_fanout(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    loads = t.orders.select(
        F.col("o_orderkey").alias("load_name"), F.col("o_orderstatus").alias("status_id"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("transporter_id"),
        "o_orderkey", "o_custkey")
    tr = t.region.select(F.col("r_regionkey"), F.col("r_name").alias("transporter"))
    so = t.lineitem.select("l_orderkey", F.col("l_suppkey").alias("loading_point"),
                           F.col("l_linenumber").alias("supplier_order_number"),
                           F.col("l_partkey").alias("supplier_ref"))
    bo = t.customer.select("c_custkey", F.col("c_name").alias("buyer"),
                           F.col("c_nationkey").alias("delivery_point_id"))
    veh = t.nation.select(F.col("n_regionkey"), F.col("n_name").alias("fleet"))
    j = (loads.join(tr, F.col("transporter_id") == F.col("r_regionkey"))
         .join(so, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(bo, F.col("c_custkey") == F.col("o_custkey"))
         .join(veh, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.select("load_name", "status_id", "transporter_id", "transporter", "fleet",
                    "loading_point", "supplier_order_number", "supplier_ref", "buyer",
                    "delivery_point_id")


def _supplier_order_rows(t: DriverTables) -> DataFrame:
    """orders as supplier orders, left-joined to their load (customer), the
    buyer orders on it (lineitem) and the deal (supplier keyed by the
    customer key: most orders have none)."""
    so = t.orders.select(F.col("o_orderkey").alias("supplier_order"),
                         F.col("o_orderstatus").alias("status_id"),
                         F.col("o_orderdate").alias("placed_date"),
                         F.col("o_totalprice").alias("litres"), "o_custkey")
    loads = t.customer.select("c_custkey", F.col("c_name").alias("load_no"))
    bo = t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("buyer_order"))
    deal = t.supplier.select("s_suppkey", F.col("s_name").alias("supply_deal"))
    return (so.join(loads, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(bo, F.col("supplier_order") == F.col("l_orderkey"), "left")
            .join(deal, F.col("o_custkey") == F.col("s_suppkey"), "left"))


# Supplier orders, one row per buyer order on the load.
def supplier_orders(spark, sf_dir) -> DataFrame:
    j = _supplier_order_rows(_t(spark, sf_dir))
    return j.select("supplier_order", "status_id", "placed_date", "litres", "load_no",
                    "buyer_order", "supply_deal")


# Supplier orders with the sorted list of buyer orders and the split flag.
def split_orders(spark, sf_dir) -> DataFrame:
    j = _supplier_order_rows(_t(spark, sf_dir))
    return collect_and_flag(j, ["supplier_order", "status_id", "placed_date", "litres",
                                "load_no", "supply_deal"],
                            "buyer_order", "buyer_orders", "split_load")


# Two-sided ledger per deal (part): sold ('O' lines of non-'P' orders)
# vs purchased ('F' lines of non-'O' orders), zero-fallback litres.
def deal_balance(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    li, o, p, n = t.lineitem, t.orders, t.part, t.nation
    final = F.round(F.col("l_tax") * 100)
    uplifted = F.round(F.col("l_discount") * 100)
    deal_ids = p.select(F.col("p_partkey").alias("deal_id"))
    sold = (li.filter(F.col("l_linestatus") == "O")
            .join(o, (F.col("o_orderkey") == F.col("l_orderkey"))
                  & (F.col("o_orderstatus") != "P"))
            .join(deal_ids, F.col("deal_id") == F.col("l_partkey"))
            .select("deal_id", zero_fallback(final, "l_quantity").alias("bo")))
    bought = (li.filter(F.col("l_linestatus") == "F")
              .join(o, (F.col("o_orderkey") == F.col("l_orderkey"))
                    & (F.col("o_orderstatus") != "O"))
              .join(deal_ids, F.col("deal_id") == F.col("l_partkey"))
              .select("deal_id", zero_fallback(final, uplifted, "l_quantity").alias("so")))
    agg = two_sided_ledger(sold, bought, "deal_id", "bo", "so", "sold_litres",
                           "purchased_litres")
    deals = (p.join(n.select("n_nationkey"), F.col("n_nationkey") == F.col("p_size"))
             .select(F.col("p_partkey").alias("deal_id"), F.col("p_name").alias("deal_identifier"),
                     F.col("p_type").alias("product"), F.col("p_brand").alias("depot"),
                     F.col("p_size").alias("volume"), F.col("p_retailprice").alias("rebate")))
    return agg.join(deals, "deal_id").select(
        "deal_identifier", "deal_id", "product", "depot", "volume",
        "sold_litres", "purchased_litres", "rebate")


# Inner restrict chain + deduped lookups + existence flag + guarded
# unit price ROUND(amount / litres, 3) as an exact decimal.
def unit_pricing(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    li, s, p, o = t.lineitem, t.supplier, t.part, t.orders
    auth = latest_per_key(
        o.select(F.col("o_orderkey").alias("auth_id"),
                 (F.col("o_orderstatus") == "F").alias("is_authorised"),
                 (F.col("o_orderpriority") == "1-URGENT").alias("is_manual")),
        ["auth_id"], [F.col("auth_id").asc()])
    j = (li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(p, F.col("l_partkey") == F.col("p_partkey"))
         .join(auth, F.col("auth_id") == F.col("l_orderkey"), "left"))
    returned = li.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("linked_order"))
    j = existence_flag(j, returned, [("l_orderkey", "linked_order")], "is_order")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    litres = F.col("l_quantity").cast("long")
    unit = F.when(F.col("l_quantity") > 0, half_up_ratio(cents, litres * 100, 3))
    return j.select(F.to_date("l_shipdate").alias("ship_date"), "l_orderkey", "l_linenumber",
                    "l_partkey", F.col("s_name").alias("depot"), F.col("p_name").alias("product"),
                    F.col("l_quantity").alias("litres"), F.col("l_extendedprice").alias("amount"),
                    "is_authorised", "is_manual", "is_order", unit.alias("unit_price"))


# Fact x depot with renames.
def supplier_manager(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    j = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.select(F.to_date("l_shipdate").alias("ship_date"), "l_orderkey", "l_linenumber",
                    F.col("l_suppkey").alias("supply_site_id"),
                    F.col("l_quantity").alias("litre_amount"),
                    F.col("l_extendedprice").alias("transaction_amount"),
                    F.col("s_name").alias("depot_manager"),
                    F.col("s_nationkey").alias("depot_region"))


# One row per account with a manager. customer as account profiles:
# the account is the market segment (five accounts: every group is hot), the
# manager is the customer's name, empty ('') for a negative balance and then
# dropped (NULLIF ... IS NOT NULL). The order is the account itself, so all
# rows of a group tie; the remaining columns break the tie.
def account_manager(spark, sf_dir) -> DataFrame:
    c = _t(spark, sf_dir).customer
    manager = F.nullif(F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_name")),
                       F.lit(""))
    profiles = (c.filter(manager.isNotNull())
                .select(F.col("c_mktsegment").alias("account"),
                        F.col("c_custkey").alias("internal_id"), manager.alias("account_manager")))
    return latest_per_key(profiles, ["account"], [F.col("account").asc()])


# Existence flag of a label per document.
def label_flag(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    return existence_flag(d, t.labels, ["doc_id"], "has_label")
def _buyer_order_base(t: DriverTables) -> DataFrame:
    """orders as buyer orders. Money as exact decimals: price per litre =
    total * 0.001, grid price = total * 0.0011, adjusted price = the
    customer's balance * 0.01; urgent/high orders are deliveries."""
    o = t.orders
    total = F.col("o_totalprice").cast("decimal(18,2)")
    delivery = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return o.select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("cust"),
        F.col("o_orderstatus").alias("status_title"),
        F.col("o_orderpriority").alias("product"),
        delivery.alias("is_for_delivery"),
        F.when(delivery, F.col("o_orderpriority")).alias("delivery_depot"),
        F.col("o_orderstatus").alias("depot_title"),
        (total * F.lit(Decimal("0.001"))).alias("buyer_price"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("price_units"),
        (total * F.lit(Decimal("0.0011"))).alias("grid_price"),
        F.col("o_orderdate").alias("invoice_date"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Own Stock Purchase")).alias("pricing_model"))


def _wms_and_load(t: DriverTables) -> DataFrame:
    """One pass over lineitem per order: the conditional pivot of the linked
    amounts by type ('A' commission, 'N' interest, 'R' invoice), the litres,
    and the newest load (highest line number; lowest supplier, part on a
    tie) -- a max over a struct, so it shares the pivot's shuffle."""
    li = t.lineitem
    ep = F.col("l_extendedprice").cast("decimal(18,2)")
    linked = li.select(
        "l_orderkey", "l_returnflag", "l_quantity",
        F.when(F.col("l_returnflag") == "A", ep * F.col("l_discount").cast("decimal(18,2)"))
        .when(F.col("l_returnflag") == "N", F.col("l_tax").cast("decimal(18,2)"))
        .otherwise(ep).alias("linked_amount"),
        F.struct(F.col("l_linenumber").alias("load_number"),
                 (-F.col("l_suppkey")).alias("neg_supp"),
                 (-F.col("l_partkey")).alias("neg_part")).alias("load"))
    return conditional_pivot(
        linked, ["l_orderkey"], "l_returnflag", "linked_amount",
        {"commission_wms": "A", "interest_wms": "N", "invoice_amount_wms": "R"},
        extra=[F.sum("l_quantity").alias("final_litres"), F.max("load").alias("top_load")])


def _rebate_prices(t: DriverTables, bo: DataFrame) -> DataFrame:
    """Purchase price from the customer's price band valid at the order
    date, newest band first. Collection: raw bounds, '>' when open-ended,
    grid price - rebate. Delivery: day-snapped bounds, '>=' from the snapped
    start, (adjusted price if > 0 else price) - rebate. An order is one or the
    other: one pass, with the bounds of its kind."""
    bands = _price_bands(t).select(
        "*", (F.col("rebate").cast("decimal(18,2)") * F.lit(Decimal("0.0001"))).alias("rebate_dec"),
        F.explode(F.array(F.lit(False), F.lit(True))).alias("band_delivery"))
    snapped = F.col("band_delivery")
    own = ["order_key", "is_for_delivery", "grid_price", "buyer_price", "adjusted_price"]
    best = newest_valid(
        bo.select(*own, "cust", "invoice_date"), bands,
        [("cust", "band_cust"), ("is_for_delivery", "band_delivery")], own, at="invoice_date",
        lower=F.col("eff_from"), upper=F.when(snapped, end_of_snapped_day("eff_to")).otherwise(F.col("eff_to")),
        is_open=_open(), newest=["eff_from", "band_order"],
        open_lower=F.when(snapped, snap_to_day("eff_from")).otherwise(F.col("eff_from")),
        open_inclusive=snapped, bucket_days=VALIDITY_BUCKET_DAYS)
    base = F.when(~F.col("is_for_delivery"), F.col("grid_price")) \
        .when(F.col("adjusted_price") > 0, F.col("adjusted_price")).otherwise(F.col("buyer_price"))
    return best.select(F.col("order_key").alias("rebate_key"), (base - F.col("rebate_dec")).alias("rebate_price"))


# Buyer orders with pivoted linked amounts, the newest load, rebate
# prices from validity joins, the price waterfall, paid flag and interest.
def buyer_orders(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    cust = t.customer.select(F.col("c_custkey"), F.col("c_name").alias("buyer"),
                             F.col("c_mktsegment").alias("buyer_category"),
                             (F.col("c_acctbal").cast("decimal(18,2)") * F.lit(Decimal("0.01")))
                             .alias("adjusted_price"))
    bo = _buyer_order_base(t).join(cust, F.col("cust") == F.col("c_custkey"))
    wms = _wms_and_load(t)
    load = wms.select("l_orderkey", "commission_wms", "interest_wms", "invoice_amount_wms",
                      "final_litres",
                      F.col("top_load.load_number").alias("load_number"),
                      (-F.col("top_load.neg_supp")).alias("load_supp"),
                      (-F.col("top_load.neg_part")).alias("linked_deal"))
    supp = t.supplier.select("s_suppkey", F.col("s_name").alias("supplier_order"), "s_nationkey")
    nat = t.nation.select("n_nationkey", F.col("n_name").alias("supplier_depot"),
                          F.col("n_regionkey").alias("transporter_id"))
    tr = t.region.select("r_regionkey", F.col("r_name").alias("transporter"))
    pd = payment_dates(spark, sf_dir).select(F.col("order_key").alias("pd_key"), "payment_date")
    # All order-keyed sides first (they are aggregated or ranked per order,
    # so they are already partitioned by it), then the lookups by supplier.
    j = (bo.join(pd, F.col("order_key") == F.col("pd_key"), "left")
         .join(load, F.col("order_key") == F.col("l_orderkey"), "left")
         .join(_rebate_prices(t, bo), F.col("order_key") == F.col("rebate_key"), "left")
         .join(supp, F.col("load_supp") == F.col("s_suppkey"), "left")
         .join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left")
         .join(tr, F.col("transporter_id") == F.col("r_regionkey"), "left"))
    litres = F.col("final_litres")
    units_l = litres.cast("long")
    has_comm = F.col("commission_wms").isNotNull() & (litres > 0)
    comm_units = (F.col("commission_wms") * 10000).cast("long")
    # ROUND(price - commission / litres, 4) with price = units / 1e5
    fallback = F.when(has_comm, half_up_ratio(F.col("price_units") * units_l - comm_units * 10,
                                              units_l * 100000, 4)) \
        .otherwise(F.lit(0).cast("decimal(18,4)"))
    purchase = F.round(F.coalesce(F.col("rebate_price"), fallback),
                       4).cast("decimal(18,4)")
    days = calendar_day_diff("payment_date", "invoice_date")
    interest_wms = F.col("interest_wms")
    interest = (F.when((interest_wms == 0) | interest_wms.isNull(), F.lit(0).cast("decimal(18,2)"))
                .when(F.col("payment_date").isNotNull(),
                      half_up_ratio(units_l * F.col("price_units") * days, 365000000, 2))
                .otherwise(F.lit(0).cast("decimal(18,2)")))
    no_delivery = F.col("delivery_depot").isNull()
    d2 = "decimal(18,2)"
    return j.select(
        F.col("order_key").alias("buyer_order_id"), "buyer", "status_title",
        litres.alias("litres"), "invoice_date", "product",
        F.when(no_delivery, F.col("depot_title")).otherwise(F.col("supplier_depot")).alias("depot"),
        F.col("delivery_depot").alias("delivery_point"), "load_number", "transporter",
        "supplier_order", "linked_deal",
        F.when(no_delivery, F.lit("Collection")).otherwise(F.lit("Delivery")).alias("order_type"),
        "buyer_category",
        F.col("payment_date").isNotNull().alias("order_paid"),
        purchase.alias("purchase_price"), purchase.alias("purchase_price_numeric"),
        F.round("buyer_price", 4).cast("decimal(18,4)").alias("selling_price"),
        F.col("buyer_price").cast("decimal(18,5)").alias("selling_price_numeric"),
        F.round(litres.cast("decimal(18,0)") * F.col("buyer_price"), 2).cast(d2)
        .alias("invoice_amount"),
        F.round("invoice_amount_wms", 2).cast(d2).alias("invoice_amount_wms"),
        F.round("commission_wms", 2).cast(d2).alias("commission_wms"),
        F.round(F.when(has_comm, F.col("commission_wms")).otherwise(F.lit(0)), 2).cast(d2)
        .alias("commission"),
        "payment_date", interest.alias("interest"),
        F.round(interest_wms, 2).cast(d2).alias("interest_wms"),
        F.col("invoice_date").alias("captured_date"),
        F.when(F.col("pricing_model") == "Own Stock Purchase", F.lit("Stock delivery"))
        .otherwise(F.lit("Stock allocation")).alias("stock_type"))
