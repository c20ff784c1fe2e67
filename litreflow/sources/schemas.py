"""Explicit schemas of the raw tables the marts read.

The source systems declare tables by name only; these column lists are the
columns the marts read, with types deduced from how they are used (IDs are
GUID strings, DATETIME is ``timestamp_ntz``, money and litres are doubles).
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "d": T.DoubleType(),
    "b": T.BooleanType(),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
    "i": T.IntegerType(),
    "l": T.LongType(),
}


def schema(spec: str) -> T.StructType:
    """``"A s, B d, C ts"`` -> StructType (all columns nullable)."""
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


# --- fixed values: column lists per (dataset, table) as read by the marts ---
SCHEMAS: dict[tuple[str, str], T.StructType] = {
    # --- fuel-card domain -------------------------------------------------
    ("tfn_monday", "depot_info"): schema(
        "supply_site_id s, Region s, Status s, Name s, PAX s, Operating_License s, "
        "Supplier_Manager s, Grid_Zone s, Price_Structure s, Live_Location s, GPS s, "
        "Depot_Type s, TFN_depot_number s, routes s, Promotions s"),
    ("tfn_monday", "new_customer_program"): schema(
        "Account_Number s, Lead_Capture_date date, AM s, Date_Active date"),
    ("tfn_monday", "customer_profile"): schema(
        "Account_Number s, Internal_ID s, Account_Manager s"),
    ("tfn_ops_dashboards", "tfn_promotions_at_depot"): schema(
        "CapturedDate date, SupplySiteID s, ProductID s, "
        "SupplierDiscountPerLitre d, TFNDiscountPerLitre d"),
    ("tfn_ops_dashboards", "precalculated_transaction_data_partitioned"): schema(
        "date date, Customer s, FullNumber s, SupplySiteID s, DepotName s, LitreAmount d, "
        "TransactionAmount d, Region s, VehicleID s, Registration s, ProductTitle s, "
        "ProductCategory s, TransactionID s, SupplierDiscountPerLitre d, TFNDiscountPerLitre d"),
    ("tfn_reports", "orders"): schema(
        "OrderNumberTitle s, OrderInstanceID s, CapturedDate ts, VehicleID s, "
        "CustomerNumber s, SupplySiteID s, SupplySiteNumber s, ProductCode s, "
        "Registration s, MaxLitres d, MaxAmount d, ValidDateStart ts, ValidDateEnd ts"),
    ("tfn_data", "order_instance_item"): schema(
        "OrderInstanceID s, VehicleID s, DriverID s, CardID s, IsDeleted b"),
    ("tfn_data", "order_instance_item_linked_transaction"): schema("TransactionID s"),
    ("tfn_reports", "card_authorisations_all_time"): schema(
        "CapturedDate ts, VehicleID s, SupplySiteID s, CardAuthorisationID s, "
        "CardID s, IsDeleted b"),
    ("tfn_data_historical", "card_authorisations"): schema(
        "CardAuthorisationID s, isAuthorised b, IsManual b"),
    ("tfn_data", "customer_authorisation_code"): schema(
        "DriverID s, CardID s, CustomerID s, Code s, ExpiryDate ts, CapturedDate ts"),
    ("tfn_reports", "tfn_all_transactions"): schema(
        "CapturedDate ts, CustomerID s, TFNCustomerID s, SupplySiteID s, "
        "LitreAmount d, Amount d, DepotName s, TransactionID s, FunderID s, "
        "CardAuthorisationID s, ProductID s, AgentID s"),
    ("tfn_data_historical", "fuel_transactions"): schema(
        "TFNCustomerID s, CustomerID s, FuelTransactionID s, CardAuthorisationID s, "
        "CardAuthorisationCustomerID s, CardPaymentMachineOwnedByID s, DeviceID s, "
        "LinkedFunderTransactionEntryID s, LinkedFunderTransactionEntrySet s, "
        "FunderID s, CapturedDate ts, GridPrice d, TransactionAmount d, "
        "LitreAmount d, DiscountFromSupplier d, SubAccountTransactionAmount d, "
        "LinkedTransactionEntryID s, NoSystemEffect b, IsDeleted b, "
        "ReportingOnly b, Reversed b, SupplySiteID s, PromotionID s, ProductID s, "
        "AgentID s, ServiceProviderID s"),
    ("tfn_data_historical", "customer"): schema("CustomerID s, Title s"),
    ("tfn_data", "supply_site"): schema("SupplySiteID s, Title s"),
    ("tfn_data", "tfn_demo_customer"): schema(
        "CustomerID s, Title s, FullNumber s, ServiceProvider s, AreaID s"),
    ("tfn_data", "tfn_funder"): schema("FunderID s, FunderTitle s"),
    ("tfn_data", "tfn_product"): schema("ProductID s, Title s, ProductCategoryID s"),
    ("tfn_data", "tfn_product_category"): schema("ProductCategoryID s, Title s"),
    ("tfn_data", "tfn_area"): schema("AreaID s, Title s"),
    ("tfn_data", "tfn_agent"): schema("AgentID s, Name s"),
    ("tfn_data", "tfn_pricing_2022_transaction"): schema(
        "FuelTransactionID s, Pricing2022ConsignmentInvoiceID s"),
    ("tfn_data", "tfn_pricing_2022_consignmnent_invoice"): schema(
        "Pricing2022ConsignmentInvoiceID s, ConsignmentPrice d, NetLitres d"),
    ("tfn_data", "tfn_fuel_transaction_discount_all_time"): schema(
        "FuelTransactionID s, SitePumpPrice d"),
    ("tfn_data", "vehicle"): schema("VehicleID s, VIN s"),
    ("tfn_data", "vbi_vehicle_tank_size"): schema(
        "CustomerName s, TFNCustomerID s, CustomerID s, Registration s, "
        "ConfiguredFuelTankSize d, CurrentVehicleStatus s, CalculatedFuelTankSize d, "
        "AverageTransactionLitres d, VehicleID s"),
    # --- wholesale domain -------------------------------------------------
    ("nto_data", "nto_buyer_order"): schema(
        "BuyerOrderID s, OrderNumber s, OrderNumberTitle s, CustomerID s, "
        "CustomerTitle s, StatusID s, StatusTitle s, FinalLitres d, RequestedLitres d, "
        "BuyerPrice d, AdjustedBuyerPrice d, FinalDepotGridPrice d, "
        "BuyerRebateValueID s, IsForDelivery b, InvoiceDate ts, PlacedDate ts, "
        "DeliveryDate ts, ModifiedDate ts, CapturedDate ts, ProductTitle s, "
        "DepotTitle s, DeliveryDepotTitle s, DeliveryDepotID s, CustomerReference s, "
        "buyerOrderPricingModelTitle s, LoadID s, AdhocFixedVolumeDealID s"),
    ("nto_data", "nto_supplier_order"): schema(
        "OrderNumberTitle s, OrderNumber s, SupplySiteTitle s, StatusID s, "
        "StatusTitle s, PlacedDate ts, RequestedLitres d, UpliftedLitres d, "
        "FinalLitres d, SupplierReference s, SupplierReference2 s, ProductTitle s, "
        "DepotTitle s, AdhocFixedVolumeDealID s, ReleaseNumber s, LoadID s, "
        "Comment s, ModifiedDate ts, CapturedDate ts"),
    ("nto_data", "nto_loads"): schema(
        "LoadID s, LoadNumber s, LoadNumberTitle s, StatusID s, StatusTitle s, "
        "TransporterID s, DriverFullName s"),
    ("nto_data", "nto_transporter"): schema("TransporterID s, TransporterTitle s"),
    ("nto_data", "nto_vehicle"): schema("TransporterID s, FleetNumber s"),
    ("nto_data", "nto_customer"): schema("CustomerID s, CustomerCategory s"),
    ("nto_data", "nto_order_load_transaction_all_types"): schema(
        "BuyerOrderID s, OrderLoadTransactionTypeID s, LinkedAmount d, "
        "TransactionID s, TransactionDate ts, CapturedDate ts"),
    ("nto_data", "nto_order_load_linked_transaction_type"): schema(
        "OrderLoadLinkedTransactionTypeID s, Title s"),
    ("nto_data", "nto_transaction_entry"): schema(
        "TransactionEntryID s, Amount d, CapturedDate ts"),
    ("nto_data", "nto_adhoc_fixed_volume_deal"): schema(
        "AdhocFixedVolumeDealID s, DealIdentifier s, Volume d, ProductID s, "
        "DepotID s, AdhocFixedVolumeDealTypeID s, AvailableFromDate ts, "
        "StartDate ts, EndDate ts, Rebate d, FinalSupplierPrice d, "
        "InitialSupplierNetPrice d"),
    ("nto_data", "nto_adhoc_fixed_volume_deal_type"): schema("AdhocFixedVolumeDealTypeID s"),
    ("nto_data", "nto_status"): schema("StatusID s, StatusItemID s"),
    ("nto_data", "nto_product"): schema("ProductID s, Title s"),
    ("nto_data", "nto_depot"): schema("DepotID s, DepotTitle s"),
    ("nto_data", "nto_buyer_collected_rebate_value"): schema(
        "BuyerCollectedRebateValueID s, BuyerCollectedRebateID s, Rebate d, "
        "EffectiveFrom ts, EffectiveTo ts"),
    ("nto_data", "nto_sales_agent_commission_rate"): schema(
        "BuyerRebateID s, VariableRateSalesAgentRebateID s, EffectiveFrom ts, EffectiveTo ts"),
    ("nto_data", "nto_buyer_delivered_rebate_band_set"): schema(
        "BuyerDeliveredRebateBandSetID s, BuyerDeliveredRebateID s, EffectiveFrom ts"),
    ("nto_data", "nto_buyer_delivered_rebate_band_value"): schema(
        "BuyerDeliveredRebateBandValueID s, BuyerDeliveredRebateBandSetID s"),
}

# Header-only mapping seed.
SEED_SUPPLIER_ORDER_MONDAY = schema(
    "SupplierOrder s, monday_item_id s, monday_name s, SentToMonday b, "
    "created_at ts, updated_at ts")
# --- end of fixed values ----------------------------------------------------
