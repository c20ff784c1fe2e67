"""Fixed values the marts must share with the source systems.

These are data conventions of the source tables, stated here once and used
by name everywhere else.
"""

# --- fixed values -----------------------------------------------------------
# "No provider" / "no linked entry" marker used by the source systems.
NIL_GUID = "00000000-0000-0000-0000-000000000000"
# EffectiveTo value meaning "still valid" (open-ended validity).
OPEN_END = "1900-01-01"
# Status items that mean "cancelled", for buyer and supplier orders.
CANCELLED_BUYER_STATUS_ITEM = "00000000-E0CE-4A53-9751-BD24654B0622"
CANCELLED_SUPPLIER_STATUS_ITEM = "00000000-28A0-445C-8608-D7FD1F961F8A"
# Labels written by the marts.
SELF_FUNDED = "Self-Funded"
LINK_DRIVER = "Driver"
LINK_CARD_VEHICLE = "Card_Vehicle"
ORDER_COLLECTION = "Collection"
ORDER_DELIVERY = "Delivery"
OWN_STOCK_PURCHASE = "Own Stock Purchase"
STOCK_DELIVERY = "Stock delivery"
STOCK_ALLOCATION = "Stock allocation"
# Linked transaction type titles.
TITLE_PAYMENT = "Payment"
TITLE_ALLOCATION = "Allocation"
TITLE_COMMISSION = "Commission"
TITLE_INTEREST = "Interest"
TITLE_FINAL_INVOICE = "Final Invoice Transaction"
# Date bounds used by the marts.
HISTORY_START = "2018-01-01"          # transaction history lower bound (>=)
ORDERS_START = "2025-01-01"           # orders with drivers lower bound (>=)
PAYMENT_DATES_AFTER = "2025-09-01"    # payment dates view (strict >)
NEW_BUSINESS_FROM = "2025-03-01"      # new-business threshold (>=)
INTEREST_RATE = 0.10
DAYS_PER_YEAR = 365
# --- end of fixed values ----------------------------------------------------
