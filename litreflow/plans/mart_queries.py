"""The shipped marts M01-M14 over the benchmark tables, and their oracle.

Each query builds the mart function itself on ``BenchmarkSources``; each
statement states the mart's rules in DuckDB SQL over the same projections.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from litreflow import constants as K
from litreflow.plans import fuelcard, wholesale
from litreflow.plans.benchmark_sources import PROJECTIONS, BenchmarkSources, cte

#: "Now" of the active-codes mart, inside the period of the benchmark events.
CODES_AS_OF = "2024-01-20 00:00:00"

_BUILD: dict[str, Callable] = {
    "mart_m01_history": fuelcard.fuel_transactions_all_time,
    "mart_m02_orders_with_drivers": fuelcard.orders_with_drivers,
    "mart_m03_active_cards": lambda src: fuelcard.active_virtual_cards(src, as_of=CODES_AS_OF),
    "mart_m04_live_vehicles": fuelcard.live_vehicles,
    "mart_m05_data_tool": fuelcard.data_tool,
    "mart_m06_transactions": fuelcard.precalculated_transactions,
    "mart_m07_payment_dates": wholesale.payment_dates,
    "mart_m08_buyer_orders": wholesale.buyer_orders,
    "mart_m09_loads": wholesale.loads,
    "mart_m10_supplier_orders": wholesale.supplier_orders,
    "mart_m11_split_orders": wholesale.supplier_orders_with_buyer_orders,
    "mart_m12_wholesale_data": wholesale.wholesale_data,
    "mart_m13_supplier_data": fuelcard.supplier_data,
    "mart_m14_supplier_manager": fuelcard.supplier_manager,
}


class Marts(BenchmarkSources):
    """Marts that read marts: live vehicles, history and the enriched fact are
    built from the projections, not looked up."""

    def has(self, dataset: str, table: str) -> bool:
        return (dataset, table) in self._frames


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def query(build: Callable) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Marts(spark, sf_dir))
    return {name: query(build) for name, build in _BUILD.items()}


def _names(columns: list[str], of: str = "") -> str:
    return ", ".join(f'{of}"{c}"' for c in columns)


def _first(source: str, keys: str, order: str) -> str:
    """One row per keys, the first by order."""
    return (f"(SELECT * EXCLUDE place FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY {order}) AS place FROM {source}) WHERE place = 1)")


_LIVE = """live AS (
  SELECT size.*, vehicle.VIN,
         CASE WHEN CalculatedFuelTankSize > ConfiguredFuelTankSize THEN CalculatedFuelTankSize
              ELSE ConfiguredFuelTankSize END AS MaxObservedCapacity
  FROM vbi_vehicle_tank_size AS size INNER JOIN vehicle USING (VehicleID))"""

_FACT = f"""{_LIVE},
manager AS {_first("(SELECT Account_Number, Internal_ID, nullif(Account_Manager, '') AS name FROM customer_profile WHERE Account_Manager <> '')",
                   "Account_Number", "Internal_ID NULLS FIRST, name NULLS FIRST")},
program AS {_first("new_customer_program", "Account_Number",
                   "Lead_Capture_date DESC NULLS LAST, AM NULLS FIRST, Date_Active NULLS FIRST")},
discount AS (
  SELECT CapturedDate AS day, SupplySiteID AS site, ProductID AS product,
         sum(SupplierDiscountPerLitre) AS SupplierDiscountPerLitre,
         sum(TFNDiscountPerLitre) AS TFNDiscountPerLitre
  FROM tfn_promotions_at_depot GROUP BY ALL),
fact AS (
  SELECT CAST(x.CapturedDate AS DATE) AS "date", x.CustomerID, x.TFNCustomerID, x.SupplySiteID,
         who.Title AS Customer, who.FullNumber, who.ServiceProvider, manager.name AS AccountManager,
         x.LitreAmount, x.Amount AS TransactionAmount, x.DepotName,
         coalesce(payer.FunderTitle, '{K.SELF_FUNDED}') AS FunderType, place.Region, place.Status,
         card.VehicleID, live.Registration, good.Title AS ProductTitle, kind.Title AS ProductCategory,
         area.Title AS CustomerRegion, x.TransactionID, agent.Name AS AgentName, program.AM AS NCP_AM,
         program.Date_Active, program.Account_Number IS NOT NULL AS NCP,
         coalesce(program.Date_Active >= DATE '{K.NEW_BUSINESS_FROM}', FALSE) AS NewBusiness,
         discount.SupplierDiscountPerLitre, discount.TFNDiscountPerLitre
  FROM tfn_all_transactions AS x
  LEFT JOIN tfn_agent AS agent ON agent.AgentID = x.AgentID
  LEFT JOIN tfn_product AS good ON good.ProductID = x.ProductID
  LEFT JOIN tfn_product_category AS kind ON kind.ProductCategoryID = good.ProductCategoryID
  LEFT JOIN tfn_funder AS payer ON payer.FunderID = x.FunderID
  LEFT JOIN depot_info AS place ON place.supply_site_id = x.SupplySiteID
  LEFT JOIN card_authorisations_all_time AS card ON card.CardAuthorisationID = x.CardAuthorisationID
  LEFT JOIN live ON live.VehicleID = card.VehicleID
  LEFT JOIN tfn_demo_customer AS who ON who.CustomerID = x.TFNCustomerID
  LEFT JOIN tfn_area AS area ON area.AreaID = who.AreaID
  LEFT JOIN manager ON manager.Account_Number = who.FullNumber
  LEFT JOIN program ON program.Account_Number = who.FullNumber
  LEFT JOIN discount ON discount.day = CAST(x.CapturedDate AS DATE)
                    AND discount.site = x.SupplySiteID AND discount.product = x.ProductID)"""

_PAID = f"""link AS (
  SELECT row.BuyerOrderID, kind.Title AS kind, row.LinkedAmount, row.TransactionDate,
         entry.Amount AS amount,
         CASE kind.Title WHEN '{K.TITLE_ALLOCATION}' THEN row.CapturedDate
              WHEN '{K.TITLE_PAYMENT}' THEN
                if(row.TransactionID = '{K.NIL_GUID}', row.CapturedDate, entry.CapturedDate) END AS settled
  FROM nto_order_load_transaction_all_types AS row
  INNER JOIN nto_order_load_linked_transaction_type AS kind
          ON kind.OrderLoadLinkedTransactionTypeID = row.OrderLoadTransactionTypeID
  LEFT JOIN nto_transaction_entry AS entry ON entry.TransactionEntryID = row.TransactionID),
link_sum AS (
  SELECT BuyerOrderID AS paid_order,
         sum(amount) FILTER (kind = '{K.TITLE_PAYMENT}') AS paid,
         min(TransactionDate) FILTER (kind = '{K.TITLE_PAYMENT}') AS first_paid,
         max(settled) AS last_settled,
         max(LinkedAmount) FILTER (kind = '{K.TITLE_COMMISSION}') AS commission,
         max(LinkedAmount) FILTER (kind = '{K.TITLE_INTEREST}') AS interest,
         max(LinkedAmount) FILTER (kind = '{K.TITLE_FINAL_INVOICE}') AS invoice
  FROM link GROUP BY BuyerOrderID),
settled AS (
  SELECT b.BuyerOrderID, b.OrderNumberTitle AS BuyerOrder, b.OrderNumber,
         b.FinalLitres * b.BuyerPrice AS InvoiceAmount, coalesce(paid, 0) AS TotalPaid,
         if(paid >= b.FinalLitres * b.BuyerPrice, first_paid, last_settled) AS PaymentDate,
         b.CapturedDate AS OrderCapturedDate
  FROM nto_buyer_order AS b LEFT JOIN link_sum ON paid_order = b.BuyerOrderID
  WHERE b.CapturedDate > TIMESTAMP '{K.PAYMENT_DATES_AFTER}')"""

_OPEN = f"TIMESTAMP '{K.OPEN_END}'"

_REBATES = f"""band AS (
  SELECT BuyerCollectedRebateID AS rebate_id, Rebate AS value, EffectiveFrom AS since, EffectiveTo AS until,
         EffectiveTo = {_OPEN} AS is_open
  FROM nto_buyer_collected_rebate_value),
collected AS (
  SELECT v.BuyerCollectedRebateValueID AS value_id,
         max_by(struct_pack(v := band.value), (rate.EffectiveFrom, band.value IS NULL, band.value)) AS best
  FROM nto_buyer_collected_rebate_value AS v
  INNER JOIN nto_sales_agent_commission_rate AS rate ON rate.BuyerRebateID = v.BuyerCollectedRebateID
  INNER JOIN band ON band.rebate_id = rate.VariableRateSalesAgentRebateID
         AND (rate.EffectiveFrom BETWEEN since AND until OR is_open AND rate.EffectiveFrom > since)
  GROUP BY ALL),
delivered AS (
  SELECT v.BuyerDeliveredRebateBandValueID AS value_id,
         max_by(struct_pack(v := band.value), (rate.EffectiveFrom, band.value IS NULL, band.value)) AS best
  FROM nto_buyer_delivered_rebate_band_value AS v
  INNER JOIN nto_buyer_delivered_rebate_band_set AS s USING (BuyerDeliveredRebateBandSetID)
  INNER JOIN nto_sales_agent_commission_rate AS rate ON rate.BuyerRebateID = s.BuyerDeliveredRebateID
         AND (s.EffectiveFrom BETWEEN rate.EffectiveFrom
                AND date_trunc('day', rate.EffectiveTo + INTERVAL 1 HOUR) - INTERVAL 1 SECOND
              OR rate.EffectiveTo = {_OPEN}
                 AND s.EffectiveFrom >= date_trunc('day', rate.EffectiveFrom + INTERVAL 1 HOUR))
  INNER JOIN band ON band.rebate_id = rate.VariableRateSalesAgentRebateID
         AND (rate.EffectiveFrom BETWEEN since AND until OR is_open AND rate.EffectiveFrom >= since)
  GROUP BY ALL)"""

_SUPPLIER_COLUMNS = ("so.OrderNumberTitle AS SupplierOrder, so.SupplySiteTitle AS Supplier, so.StatusID, "
                     "so.StatusTitle, so.PlacedDate, so.RequestedLitres AS Litres, so.FinalLitres, "
                     "so.SupplierReference AS SupplierRef1, so.SupplierReference2 AS SupplierRef2, "
                     "so.ProductTitle AS Product, so.DepotTitle AS SupplyDepot, "
                     "deal.DealIdentifier AS SupplyDeal, so.ReleaseNumber, load.LoadNumberTitle AS LoadNo")
_SUPPLIER_ROWS = """FROM nto_supplier_order AS so
LEFT JOIN nto_adhoc_fixed_volume_deal AS deal USING (AdhocFixedVolumeDealID)
LEFT JOIN nto_loads AS load ON load.LoadID = so.LoadID
LEFT JOIN nto_buyer_order AS bo ON bo.LoadID = so.LoadID"""

_DEPOT = ", ".join(f'place."{c}"' for c in fuelcard._DEPOT_COLUMNS if c != "Supplier_Manager")

_STATEMENTS = {
    "mart_m01_history": f"""
SELECT {_names(fuelcard.HISTORY_COLUMNS)} FROM fuel_transactions
WHERE CapturedDate >= TIMESTAMP '{K.HISTORY_START}'""",
    "mart_m02_orders_with_drivers": f"""
WITH {_LIVE},
line AS (
  SELECT w.OrderNumberTitle, item.DriverID, w.CapturedDate, item.CardID, who.FullNumber,
         place.Name AS DepotName, who.Title AS CustomerName, item.IsDeleted, w.VehicleID, w.CustomerNumber,
         w.SupplySiteNumber AS SupplierNumber, w.ProductCode, w.Registration AS VehicleRegistration,
         w.MaxLitres, w.MaxAmount, w.ValidDateStart, w.ValidDateEnd
  FROM tfn_reports_orders AS w
  LEFT JOIN live USING (VehicleID)
  LEFT JOIN tfn_demo_customer AS who ON who.CustomerID = live.TFNCustomerID
  LEFT JOIN depot_info AS place ON place.supply_site_id = w.SupplySiteID
  LEFT JOIN order_instance_item AS item ON item.VehicleID = w.VehicleID
                                       AND item.OrderInstanceID = w.OrderInstanceID
  WHERE w.CapturedDate >= TIMESTAMP '{K.ORDERS_START}')
SELECT * FROM {_first("line", "OrderNumberTitle, DriverID, CapturedDate, VehicleID, CardID, CustomerName",
                      "FullNumber NULLS FIRST, DepotName NULLS FIRST, IsDeleted NULLS FIRST, "
                      "CustomerNumber NULLS FIRST, SupplierNumber NULLS FIRST, ProductCode NULLS FIRST, "
                      "VehicleRegistration NULLS FIRST, MaxLitres NULLS FIRST, MaxAmount NULLS FIRST, "
                      "ValidDateStart NULLS FIRST, ValidDateEnd NULLS FIRST")}""",
    "mart_m03_active_cards": f"""
WITH good AS (
  SELECT * FROM customer_authorisation_code
  WHERE ExpiryDate > TIMESTAMP '{CODES_AS_OF}' AND CapturedDate < TIMESTAMP '{CODES_AS_OF}'),
by_vehicle AS (
  SELECT c.VehicleID, good.Code, good.CardID, good.CustomerID, good.CapturedDate, c.IsDeleted, good.ExpiryDate
  FROM good INNER JOIN card_authorisations_all_time AS c USING (CardID))
SELECT DriverID, NULL AS VehicleID, ExpiryDate, NULL AS CardID, NULL AS CustomerID,
       Code AS CurrentVirtualCardNumber, '{K.LINK_DRIVER}' AS LinkType
FROM {_first("good", "DriverID", "ExpiryDate DESC NULLS LAST, CapturedDate DESC NULLS LAST, Code")}
UNION ALL
SELECT NULL, VehicleID, ExpiryDate, CardID, CustomerID, Code, '{K.LINK_CARD_VEHICLE}'
FROM {_first("by_vehicle", "VehicleID", "CapturedDate DESC NULLS LAST, ExpiryDate DESC NULLS LAST, Code, CardID, CustomerID")}""",
    "mart_m04_live_vehicles": f"WITH {_LIVE} SELECT * FROM live",
    "mart_m05_data_tool": f"""
SELECT CAST(t.CapturedDate AS DATE) AS "Date", t.TFNCustomerID, t.ServiceProviderID, t.CustomerID,
       t.SupplySiteID, site.Title AS Depot, payer.Title AS Customer, sum(t.LitreAmount) AS LitreAmount
FROM fuel_transactions AS t
INNER JOIN supply_site AS site ON site.SupplySiteID = t.SupplySiteID
INNER JOIN customer_titles AS payer ON payer.CustomerID =
      if(t.ServiceProviderID <> '{K.NIL_GUID}', t.ServiceProviderID, t.CustomerID)
WHERE NOT t.Reversed AND NOT t.IsDeleted AND NOT t.ReportingOnly
GROUP BY ALL""",
    "mart_m06_transactions": f"WITH {_FACT} SELECT * FROM fact",
    "mart_m07_payment_dates": f"WITH {_PAID} SELECT * FROM settled",
    "mart_m08_buyer_orders": f"""
WITH {_PAID},
{_REBATES},
load_row AS {_first('nto_loads', 'LoadID', 'LoadNumberTitle NULLS FIRST, TransporterID NULLS FIRST')},
supply AS {_first('''(SELECT so.LoadID, so.OrderNumberTitle AS number, so.SupplierReference AS ref1,
    so.SupplierReference2 AS ref2, so.DepotTitle AS depot, deal.DealIdentifier AS deal
  FROM nto_supplier_order AS so LEFT JOIN nto_adhoc_fixed_volume_deal AS deal USING (AdhocFixedVolumeDealID))''',
                  'LoadID', 'number NULLS FIRST, ref1 NULLS FIRST, ref2 NULLS FIRST, depot NULLS FIRST, deal NULLS FIRST')},
priced AS (
  SELECT b.*, settled.PaymentDate, s.commission, s.interest, s.invoice,
         round(CASE WHEN b.IsForDelivery = FALSE AND c.best IS NOT NULL AND b.FinalDepotGridPrice - c.best.v IS NOT NULL
                    THEN b.FinalDepotGridPrice - c.best.v
                    WHEN b.IsForDelivery AND d.best IS NOT NULL AND d.best.v IS NOT NULL
                    THEN if(b.AdjustedBuyerPrice > 0, b.AdjustedBuyerPrice, b.BuyerPrice) - d.best.v
                    WHEN s.commission IS NOT NULL AND b.FinalLitres > 0
                    THEN b.BuyerPrice - s.commission / b.FinalLitres ELSE 0 END, 4) AS price
  FROM nto_buyer_order AS b
  LEFT JOIN settled USING (BuyerOrderID)
  LEFT JOIN link_sum AS s ON s.paid_order = b.BuyerOrderID
  LEFT JOIN collected AS c ON c.value_id = b.BuyerRebateValueID
  LEFT JOIN delivered AS d ON d.value_id = b.BuyerRebateValueID)
SELECT p.OrderNumberTitle AS BuyerOrder, p.CustomerTitle AS Buyer, p.StatusID, p.StatusTitle,
       p.FinalLitres AS Litres, p.InvoiceDate, p.PlacedDate, p.ProductTitle AS Product,
       if(p.DeliveryDepotTitle IS NULL, p.DepotTitle, supply.depot) AS Depot,
       p.DeliveryDepotTitle AS DeliveryPoint, load_row.LoadNumberTitle AS LoadNumber,
       mover.TransporterTitle AS Transporter, supply.number AS SupplierOrder, supply.ref1 AS SupplierRef1,
       supply.ref2 AS SupplierRef2, supply.deal AS LinkedSupplyDeal,
       if(p.DeliveryDepotTitle IS NULL, '{K.ORDER_COLLECTION}', '{K.ORDER_DELIVERY}') AS OrderType,
       buyer.CustomerCategory AS BuyerCategory, p.PaymentDate IS NOT NULL AS OrderPaid,
       p.CustomerReference AS POD, p.ModifiedDate, p.price AS PurchasePrice, p.price AS PurchasePriceNumeric,
       round(p.BuyerPrice, 4) AS SellingPrice, p.BuyerPrice AS SellingPriceNumeric,
       round(p.FinalLitres * p.BuyerPrice, 2) AS InvoiceAmount, round(p.invoice, 2) AS InvoiceAmountWMS,
       round(p.commission, 2) AS CommissionWMS,
       round(if(p.commission IS NOT NULL AND p.FinalLitres > 0, p.commission, 0), 2) AS Commission,
       p.PaymentDate,
       round(if(coalesce(p.interest, 0) = 0 OR p.PaymentDate IS NULL, 0,
                p.FinalLitres * p.BuyerPrice
                * date_diff('day', CAST(p.InvoiceDate AS DATE), CAST(p.PaymentDate AS DATE))
                / {K.DAYS_PER_YEAR} * {K.INTEREST_RATE}), 2) + 0.0 AS Interest,
       round(p.interest, 2) AS InterestWMS, p.DeliveryDepotTitle AS DeliveryDepot, p.CapturedDate,
       if(coalesce(p.buyerOrderPricingModelTitle, '') = '{K.OWN_STOCK_PURCHASE}', '{K.STOCK_DELIVERY}',
          '{K.STOCK_ALLOCATION}') AS StockType
FROM priced AS p
INNER JOIN nto_customer AS buyer USING (CustomerID)
LEFT JOIN load_row ON load_row.LoadID = p.LoadID
LEFT JOIN supply ON supply.LoadID = p.LoadID
LEFT JOIN nto_transporter AS mover ON mover.TransporterID = load_row.TransporterID""",
    "mart_m09_loads": """
SELECT load.LoadNumber AS LoadName, load.StatusID, load.StatusTitle, bo.DeliveryDate, load.TransporterID,
       mover.TransporterTitle AS Transporter, truck.FleetNumber AS Fleet, load.DriverFullName AS Driver,
       so.SupplySiteTitle AS LoadingPoint, bo.DeliveryDepotID AS DeliveryPointID,
       bo.OrderNumber AS BuyerOrderNo, so.SupplierReference AS SupplierRef,
       so.OrderNumber AS SupplierOrderNumber, bo.CustomerReference AS POD
FROM nto_vehicle AS truck
INNER JOIN nto_transporter AS mover USING (TransporterID)
INNER JOIN nto_loads AS load USING (TransporterID)
INNER JOIN nto_buyer_order AS bo USING (LoadID)
INNER JOIN nto_supplier_order AS so USING (LoadID)""",
    "mart_m10_supplier_orders": f"""
SELECT {_SUPPLIER_COLUMNS}, bo.OrderNumberTitle AS BuyerOrder, so.Comment AS InternalNotes
{_SUPPLIER_ROWS}""",
    "mart_m11_split_orders": f"""
SELECT {_SUPPLIER_COLUMNS}, so.Comment AS InternalNotes, so.ModifiedDate,
       list(bo.OrderNumberTitle ORDER BY bo.OrderNumberTitle)
         FILTER (bo.OrderNumberTitle IS NOT NULL) AS BuyerOrders,
       count(bo.OrderNumberTitle) > 1 AS SplitLoad
{_SUPPLIER_ROWS} GROUP BY ALL""",
    "mart_m12_wholesale_data": f"""
WITH movement AS (
  SELECT AdhocFixedVolumeDealID, if(FinalLitres = 0, RequestedLitres, FinalLitres) AS sold,
         0.0::DOUBLE AS bought
  FROM nto_buyer_order SEMI JOIN (SELECT * FROM nto_status WHERE StatusItemID <> '{K.CANCELLED_BUYER_STATUS_ITEM}')
       USING (StatusID)
  UNION ALL
  SELECT AdhocFixedVolumeDealID, 0.0,
         if(FinalLitres = 0, if(UpliftedLitres = 0, RequestedLitres, UpliftedLitres), FinalLitres)
  FROM nto_supplier_order SEMI JOIN (SELECT * FROM nto_status WHERE StatusItemID <> '{K.CANCELLED_SUPPLIER_STATUS_ITEM}')
       USING (StatusID))
SELECT deal.DealIdentifier, deal.AdhocFixedVolumeDealID, good.Title AS Product, place.DepotTitle AS Depot,
       deal.Volume, sum(sold) AS SoldLitres, sum(bought) AS PurchasedLitres, deal.AvailableFromDate,
       deal.StartDate, deal.EndDate, deal.Rebate, deal.FinalSupplierPrice, deal.InitialSupplierNetPrice
FROM movement
INNER JOIN nto_adhoc_fixed_volume_deal AS deal USING (AdhocFixedVolumeDealID)
INNER JOIN nto_adhoc_fixed_volume_deal_type USING (AdhocFixedVolumeDealTypeID)
INNER JOIN nto_product AS good USING (ProductID)
INNER JOIN nto_depot AS place USING (DepotID)
GROUP BY ALL""",
    "mart_m13_supplier_data": f"""
WITH {_FACT},
allowed AS {_first("card_authorisations", "CardAuthorisationID", "isAuthorised NULLS FIRST, IsManual NULLS FIRST")}
SELECT {_names(fuelcard._PTD_COLUMNS, "fact.")}, {_DEPOT}, place.Supplier_Manager,
       bill.ConsignmentPrice, bill.NetLitres AS ConsignmentLitres, allowed.isAuthorised, allowed.IsManual,
       past.Reversed, past.GridPrice, pump.SitePumpPrice AS PumpPrice,
       fact.TransactionID IN (SELECT TransactionID FROM order_instance_item_linked_transaction
                              WHERE TransactionID IS NOT NULL) AS isOrder,
       CASE WHEN fact.LitreAmount > 0
            THEN round(fact.TransactionAmount / fact.LitreAmount, 3) END AS TFNPricing
FROM fact
INNER JOIN depot_info AS place ON place.supply_site_id = fact.SupplySiteID
INNER JOIN fuel_transactions AS past ON past.FuelTransactionID = fact.TransactionID
       AND past.CapturedDate >= TIMESTAMP '{K.HISTORY_START}'
INNER JOIN tfn_pricing_2022_transaction AS price ON price.FuelTransactionID = past.FuelTransactionID
LEFT JOIN tfn_pricing_2022_consignmnent_invoice AS bill USING (Pricing2022ConsignmentInvoiceID)
LEFT JOIN tfn_fuel_transaction_discount_all_time AS pump ON pump.FuelTransactionID = past.FuelTransactionID
LEFT JOIN allowed ON allowed.CardAuthorisationID = past.CardAuthorisationID""",
    "mart_m14_supplier_manager": f"""
WITH {_FACT}
SELECT {_names(fuelcard._PTD_COLUMNS, "fact.")}, {_DEPOT}, place.Supplier_Manager AS DepotManager
FROM fact INNER JOIN depot_info AS place ON place.supply_site_id = fact.SupplySiteID""",
}

#: Source tables that are named like a benchmark table.
_RENAMED = {("tfn_data_historical", "customer"): "customer_titles", ("tfn_reports", "orders"): "tfn_reports_orders"}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in _STATEMENTS.items():
        used = [cte(*key).replace(f"{key[1]} AS", f"{_RENAMED.get(key, key[1])} AS", 1) for key in PROJECTIONS
                if re.search(rf"\b{_RENAMED.get(key, key[1])}\b", body)]
        body = body.strip()
        joined = body.removeprefix("WITH ") if body.startswith("WITH ") else None
        out[name] = "WITH " + ",\n".join(used) + (",\n" + joined if joined else "\n" + body)
    return out
