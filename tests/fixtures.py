"""Hand-written source rows for the marts (schemas from
``litreflow.sources.schemas``). Each table holds the cases listed next to it."""

from __future__ import annotations

import datetime as dt

from litreflow.constants import CANCELLED_BUYER_STATUS_ITEM, CANCELLED_SUPPLIER_STATUS_ITEM, NIL_GUID
from litreflow.sources.registry import SourceRegistry

D = dt.datetime
OPEN = D(1900, 1, 1)


def fuel_row(**kw):
    cols = ["TFNCustomerID", "CustomerID", "FuelTransactionID", "CardAuthorisationID",
            "CardAuthorisationCustomerID", "CardPaymentMachineOwnedByID", "DeviceID",
            "LinkedFunderTransactionEntryID", "LinkedFunderTransactionEntrySet", "FunderID",
            "CapturedDate", "GridPrice", "TransactionAmount", "LitreAmount",
            "DiscountFromSupplier", "SubAccountTransactionAmount", "LinkedTransactionEntryID",
            "NoSystemEffect", "IsDeleted", "ReportingOnly", "Reversed", "SupplySiteID",
            "PromotionID", "ProductID", "AgentID", "ServiceProviderID"]
    base = dict(IsDeleted=False, ReportingOnly=False, Reversed=False, NoSystemEffect=False)
    base.update(kw)
    return tuple(base.get(c) for c in cols)


def registry(spark) -> SourceRegistry:
    src = SourceRegistry(spark)
    f = src.fixture
    # --- fuel-card domain -------------------------------------------------
    f("tfn_data_historical", "fuel_transactions", [
        # provider = nil -> customer's title; provider real; provider NULL
        fuel_row(FuelTransactionID="t1", TFNCustomerID="T1", CustomerID="c1", ServiceProviderID=NIL_GUID,
                 SupplySiteID="s1", CapturedDate=D(2025, 3, 1, 8), LitreAmount=10.0,
                 TransactionAmount=200.0, GridPrice=20.0, CardAuthorisationID="ca1"),
        fuel_row(FuelTransactionID="t2", TFNCustomerID="T1", CustomerID="c1", ServiceProviderID=NIL_GUID,
                 SupplySiteID="s1", CapturedDate=D(2025, 3, 1, 18), LitreAmount=5.0,
                 TransactionAmount=100.0, GridPrice=20.0),
        fuel_row(FuelTransactionID="t3", TFNCustomerID="T1", CustomerID="c1", ServiceProviderID="c2",
                 SupplySiteID="s1", CapturedDate=D(2025, 3, 1, 9), LitreAmount=7.0,
                 TransactionAmount=0.0),
        fuel_row(FuelTransactionID="t4", TFNCustomerID="T2", CustomerID="c3", ServiceProviderID=None,
                 SupplySiteID="s2", CapturedDate=D(2025, 3, 2, 9), LitreAmount=3.0,
                 TransactionAmount=60.0),
        # flags true / NULL are dropped from daily litres
        fuel_row(FuelTransactionID="t5", TFNCustomerID="T1", CustomerID="c1", ServiceProviderID=NIL_GUID,
                 SupplySiteID="s1", CapturedDate=D(2025, 3, 1, 10), LitreAmount=100.0, Reversed=True),
        fuel_row(FuelTransactionID="t6", TFNCustomerID="T1", CustomerID="c1", ServiceProviderID=NIL_GUID,
                 SupplySiteID="s1", CapturedDate=D(2025, 3, 1, 11), LitreAmount=100.0, IsDeleted=None),
        # before the history start
        fuel_row(FuelTransactionID="t0", TFNCustomerID="T1", CustomerID="c1", ServiceProviderID=NIL_GUID,
                 SupplySiteID="s1", CapturedDate=D(2017, 12, 31, 23), LitreAmount=1.0),
    ])
    f("tfn_data", "supply_site", [("s1", "Site One"), ("s2", "Site Two")])
    f("tfn_data_historical", "customer", [("c1", "Cust One"), ("c2", "Provider Two"), ("c3", "Cust Three")])
    f("tfn_data", "vehicle", [("v1", "VIN1"), ("v2", "VIN2"), ("v3", "VIN3")])
    f("tfn_data", "vbi_vehicle_tank_size", [
        ("Owner1", "T1", "c1", "REG1", 60.0, "Active", 80.0, 40.0, "v1"),    # calc > conf
        ("Owner1", "T1", "c1", "REG2", 60.0, "Active", None, 40.0, "v2"),    # calc NULL
        ("Owner2", "T2", "c3", "REG3", None, "Active", 50.0, 40.0, "v3"),    # conf NULL
    ])
    f("tfn_reports", "orders", [
        ("ON1", "oi1", D(2025, 2, 1, 9), "v1", "CN1", "s1", "SN1", "P1", "REG1", 100.0, 2000.0, None, None),
        ("ON1", "oi1", D(2025, 2, 1, 9), "v1", "CN1", "s1", "SN1", "P1", "REG1", 90.0, 2000.0, None, None),
        ("ON2", "oi2", D(2025, 2, 3, 9), "v9", "CN2", "s2", "SN2", "P1", "REG9", 50.0, 900.0, None, None),
        ("ON0", "oi0", D(2024, 12, 31, 9), "v1", "CN1", "s1", "SN1", "P1", "REG1", 50.0, 900.0, None, None),
    ])
    f("tfn_data", "order_instance_item", [("oi1", "v1", "drv1", "card1", False)])
    f("tfn_data", "tfn_demo_customer", [("T1", "Tfn One", "FN1", "SP1", "A1"),
                                        ("T2", "Tfn Two", "FN2", "SP2", "A2")])
    f("tfn_monday", "depot_info", [("s1", "North", "Live", "Depot One", "pax", "lic", "Mgr One", "z",
                                    "ps", "loc", "gps", "type", "n1", "r", "promo")])
    f("tfn_data", "customer_authorisation_code", [
        # driver d1: two valid (newest expiry wins), one expired
        ("d1", "card1", "c1", "CODE-A", D(2025, 6, 1), D(2025, 1, 1)),
        ("d1", "card1", "c1", "CODE-B", D(2025, 7, 1), D(2025, 1, 2)),
        ("d1", "card1", "c1", "CODE-X", D(2025, 1, 31), D(2024, 12, 1)),
        # not yet captured; expiry exactly at as_of (not > as_of)
        ("d2", "card2", "c2", "CODE-F", D(2025, 9, 1), D(2025, 4, 1)),
        ("d3", "card3", "c3", "CODE-E", D(2025, 3, 1), D(2025, 1, 1)),
    ])
    f("tfn_reports", "card_authorisations_all_time", [
        (D(2025, 1, 5), "v1", "s1", "ca1", "card1", True),
        (D(2025, 1, 6), "v2", "s1", "ca2", "card2", False),
    ])
    f("tfn_reports", "tfn_all_transactions", [
        (D(2025, 3, 1, 8), "c1", "T1", "s1", 10.0, 200.0, "Depot One", "t1", None, "ca1", "p1", "g1"),
        (D(2025, 3, 2, 9), "c3", "T2", "s2", 3.0, 60.0, "Depot Two", "t4", "fu1", None, "p1", None),
    ])
    f("tfn_monday", "customer_profile", [("FN1", "I1", ""), ("FN1", "I2", "Manager A"),
                                         ("FN2", "I3", None)])
    f("tfn_monday", "new_customer_program", [("FN1", dt.date(2025, 1, 1), "AM1", dt.date(2025, 3, 5)),
                                             ("FN1", dt.date(2024, 1, 1), "AM0", dt.date(2024, 1, 5))])
    f("tfn_ops_dashboards", "tfn_promotions_at_depot", [
        (dt.date(2025, 3, 1), "s1", "p1", 0.10, 0.05), (dt.date(2025, 3, 1), "s1", "p1", 0.20, 0.05)])
    f("tfn_data", "tfn_funder", [("fu1", "Funder One")])
    f("tfn_data", "tfn_product", [("p1", "Diesel", "pc1")])
    f("tfn_data", "tfn_product_category", [("pc1", "Fuel")])
    f("tfn_data", "tfn_area", [("A1", "Area One")])
    f("tfn_data", "tfn_agent", [("g1", "Agent One")])
    f("tfn_data", "tfn_pricing_2022_transaction", [("t1", "inv1")])
    f("tfn_data", "tfn_pricing_2022_consignmnent_invoice", [("inv1", 18.5, 9.5)])
    f("tfn_data", "tfn_fuel_transaction_discount_all_time", [("t1", 21.0)])
    f("tfn_data_historical", "card_authorisations", [("ca1", True, False), ("ca1", True, True)])
    f("tfn_data", "order_instance_item_linked_transaction", [("t1",), ("t1",)])
    # --- wholesale domain -------------------------------------------------
    bo_cols = None  # noqa: F841 (order follows the schema)
    f("nto_data", "nto_buyer_order", [
        # BuyerOrderID, OrderNumber, OrderNumberTitle, CustomerID, CustomerTitle, StatusID,
        # StatusTitle, FinalLitres, RequestedLitres, BuyerPrice, AdjustedBuyerPrice,
        # FinalDepotGridPrice, BuyerRebateValueID, IsForDelivery, InvoiceDate, PlacedDate,
        # DeliveryDate, ModifiedDate, CapturedDate, ProductTitle, DepotTitle,
        # DeliveryDepotTitle, DeliveryDepotID, CustomerReference, pricing model, LoadID, DealID
        ("b1", "1", "BO-1", "cu1", "Buyer One", "st1", "Open", 1000.0, 1200.0, 20.0, 0.0, 19.0,
         "rv1", False, D(2025, 9, 10, 23), None, None, None, D(2025, 9, 10), "Diesel", "Depot A",
         None, None, "POD1", "Own Stock Purchase", "L1", "deal1"),
        ("b2", "2", "BO-2", "cu1", "Buyer One", "st2", "Open", 0.0, 500.0, 20.0, 21.0, 19.0,
         "bv1", True, D(2025, 9, 11), None, None, None, D(2025, 9, 11), "Diesel", "Depot A",
         "Farm", "dd1", "POD2", None, "L1", "deal1"),
        ("b3", "3", "BO-3", "cu1", "Buyer One", "st1", "Open", 100.0, 100.0, 10.0, 0.0, 9.0,
         None, False, D(2025, 8, 1), None, None, None, D(2025, 8, 1), "Petrol", "Depot B",
         None, None, "POD3", None, None, "deal1"),
    ])
    f("nto_data", "nto_customer", [("cu1", "Retail")])
    f("nto_data", "nto_order_load_linked_transaction_type", [
        ("ty1", "Commission"), ("ty2", "Interest"), ("ty3", "Final Invoice Transaction"),
        ("ty4", "Payment"), ("ty5", "Allocation")])
    f("nto_data", "nto_order_load_transaction_all_types", [
        ("b1", "ty1", 500.0, "x1", D(2025, 9, 10), D(2025, 9, 10)),
        ("b1", "ty2", 12.5, "x2", D(2025, 9, 10), D(2025, 9, 10)),
        ("b1", "ty3", 20000.0, "x3", D(2025, 9, 10), D(2025, 9, 10)),
        ("b1", "ty4", None, "te1", D(2025, 9, 20, 1), D(2025, 9, 20, 2)),
        ("b1", "ty4", None, "te2", D(2025, 9, 25, 1), D(2025, 9, 25, 2)),
        ("b3", "ty1", 100.0, "x4", D(2025, 8, 1), D(2025, 8, 1)),
    ])
    f("nto_data", "nto_transaction_entry", [("te1", 15000.0, D(2025, 9, 21)),
                                            ("te2", 5000.0, D(2025, 9, 26))])
    f("nto_data", "nto_loads", [("L1", "LN1", "Load 1", "ls", "Loaded", "tr1", "Driver A")])
    f("nto_data", "nto_transporter", [("tr1", "Trans One")])
    f("nto_data", "nto_vehicle", [("tr1", "F1"), ("tr1", "F2")])
    f("nto_data", "nto_supplier_order", [
        ("SO-1", "so1", "Supplier A", "sst1", "Open", D(2025, 9, 1), 2000.0, 0.0, 0.0, "ref1", "ref2",
         "Diesel", "Depot S", "deal1", "rel1", "L1", "note", D(2025, 9, 2), D(2025, 9, 1)),
        ("SO-2", "so2", "Supplier A", "sst2", "Cancelled", D(2025, 9, 1), 300.0, 250.0, 0.0, "ref3",
         None, "Diesel", "Depot S", "deal1", "rel2", None, None, D(2025, 9, 2), D(2025, 9, 1)),
    ])
    f("nto_data", "nto_adhoc_fixed_volume_deal", [
        ("deal1", "DEAL-1", 10000.0, "pr1", "dp1", "dt1", D(2025, 1, 1), D(2025, 1, 1),
         D(2025, 12, 31), 0.5, 18.0, 17.5),
        ("deal2", "DEAL-2", 500.0, "pr1", "dp1", "dt1", D(2025, 1, 1), D(2025, 1, 1),
         D(2025, 12, 31), 0.5, 18.0, 17.5)])
    f("nto_data", "nto_adhoc_fixed_volume_deal_type", [("dt1",)])
    f("nto_data", "nto_status", [("st1", "item-open"), ("st2", CANCELLED_BUYER_STATUS_ITEM),
                                 ("sst1", "item-open"), ("sst2", CANCELLED_SUPPLIER_STATUS_ITEM)])
    f("nto_data", "nto_product", [("pr1", "Diesel 50")])
    f("nto_data", "nto_depot", [("dp1", "Depot D")])
    # collection chain for b1: rv1 -> rebate R1 -> rate from 2025-05-01 -> variable rebate R9
    f("nto_data", "nto_buyer_collected_rebate_value", [
        ("rv1", "R1", 0.3, D(2025, 1, 1), OPEN),
        ("rv9a", "R9", 0.5, D(2025, 1, 1), D(2025, 4, 30, 23, 59, 59)),
        ("rv9b", "R9", 0.7, D(2025, 5, 1), OPEN),    # open, from == rate start: '>' excludes
        ("rv9c", "R9", 0.9, D(2025, 4, 1), D(2025, 6, 30)),
    ])
    f("nto_data", "nto_sales_agent_commission_rate", [
        ("R1", "R9", D(2025, 5, 1), OPEN),
        ("DR1", "R9", D(2025, 5, 1, 23, 30), OPEN),
    ])
    f("nto_data", "nto_buyer_delivered_rebate_band_value", [("bv1", "bs1")])
    f("nto_data", "nto_buyer_delivered_rebate_band_set", [("bs1", "DR1", D(2025, 5, 2))])
    return src
