"""Fixed values the reference job's results depend on.

These must equal the original job's values for the same results; they are
stated here plainly, in their original order, and used as defaults of
operator parameters so a user can change them.
"""

from __future__ import annotations

import datetime as dt

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference job's)
# ---------------------------------------------------------------------------

# Time zone of wall clocks and of "today".
PARIS = "Europe/Paris"

# Order status priority (higher wins the rank of a line).
ORDER_STATUS_PRIORITY = {
    "PENDING": 1,
    "CONFIRMED": 2,
    "PICKING": 3,
    "PICKED": 4,
    "IN_SHIPMENT": 5,
    "READY_FOR_PICKUP": 6,
    "DELIVERED": 7,
    "CANCELED": 8,
    "CANCELLED": 9,
}

# Invoice status (and marketplace line status) priority.
INVOICE_STATUS_PRIORITY = {
    "EMPTY": 1,
    "PENDING": 2,
    "SENT": 11,
    "CREATED": 21,
    "VOIDED": 22,
}

# Article ids of the synthetic delivery-fee lines.
FEE_ARTICLE = "DUMMY-FRAIS_LIV"
FEE_ARTICLE_MKP = "DUMMY-FRAIS_LIV_MKP"
FEE_ARTICLE_PREFIX = "DUMMY"

# Value of fulfillmenttype that triggers the shop test (spelled with two K).
MARKETPLACE_TYPE = "MARKKETPLACE"

# Delivery type given to every FSD line, and fulfilment type of HAK orders.
FSD_DELIVERY_TYPE = "PARCEL"
HAK_TYPE = "HAK"

# Date cut-offs.
MIN_ORDER_DATE = dt.date(2018, 6, 20)             # orders before are ignored
NET_PRICE_CUTOFF = dt.datetime(2019, 5, 14, 9, 0, 0)  # sumnetdouble / no spread from here
FEE_RULE_CUTOFF = dt.datetime(2019, 10, 1)        # fee = empties gap before, delivery fees after
TAG_ORDER_CUTOFF = dt.datetime(2019, 2, 6)        # orderId from JSON text before, parsed after
TAG_BUNDLE_CUTOFF = dt.datetime(2019, 7, 10)      # bundleId likewise
EMPLOYEE_CORRECTION_START = dt.date(2020, 9, 28)  # guarantee employee correction from here

# Commission event types.
STRUCTURED_COMMISSION_EVENTS = (
    "order-submit-employee-commissions.quantity",
    "order-submit-employee-commissions.price",
    "order.submit.employeeCommissions.price",
    "order.submit.employeeCommissions.quantity",
)
COMMISSION_EVENTS = (
    "order-submit-employee-commissions.quantity",
    "order-submit-employee-commissions.price",
)

# Store attribution.
NON_ATTRIBUTABLE_STORES = (0, 91, 93, 147, 200)
STORE_REMAP = {147: 32}            # home store 147 is booked on store 32
STORE_SERVICE = "STORE"
DEFAULT_SERVICE = "CUSTOMER"

# Guarantee lines: ordering store, and the article numbers of guarantees.
GUARANTEE_STORE = 113
GUARANTEE_ARTICLE_NUMBERS = (
    156701, 163323, 650850, 163326, 163360, 650924, 163350, 163333, 163361, 687636, 156698,
    163342, 687640, 163349, 156707, 680837, 163367, 163336, 666796, 163357, 163345,
    163362, 156695, 163341, 163325, 652119, 163364, 156692, 687638, 163332, 666235, 163337,
    163329, 163352, 163355, 156697, 156700, 650866, 163330, 163338, 163356, 163343, 652132,
    666798, 163351, 650908, 163321, 163368, 156702, 163346, 163359, 157090, 687639, 650847,
    156705, 156696, 163344, 163369, 163348, 156706, 163353, 163366, 163331, 163328, 163347,
    666260, 156699, 650851, 163354, 163339, 156704, 163334, 156703, 650848, 163363,
    827176, 827177, 827178, 827179, 827180, 827933, 827939, 827940, 827942, 827944, 827955, 827950,
    827961, 827953, 827954, 827962, 827963, 827964, 827965, 827966, 827967, 827968, 827969, 828012,
    828013, 828014, 828015, 828017, 828018, 828019, 828020, 828021, 828022, 828023, 828024, 828025,
    828026, 828027, 828028, 828029, 828030, 828031, 828032, 828036, 828035,
    163358, 650852, 650853, 650855, 650857, 650858, 650892, 650893, 650896, 650897, 650899, 650905,
    652126, 652127, 652130, 652135, 666263, 666264, 680828, 680835, 680838, 681270,
)

# Orders that are originals of backorders, and what counts as a fact row.
ORIGINAL_FULFILMENT_TYPES = ("WEBSHOP", "DROPSHIPMENT", "CLICK AND COLLECT")
BACKORDER_PREFIX = "9-"
FACT_ORDER_KINDS = (1, 2)          # 1 order, 2 backorder
FACT_LOOKBACK_DAYS = 2             # look-back of the duplicate test
ORIGINAL_LOOKBACK_MONTHS = 3
FIVE_MINUTE_LOOKBACK = 10          # minutes that a five-minute pass looks back

# Backorder classes.
BACKORDER_ADDED = "Ajout"
BACKORDER_REMAINDER = "Reliquat"
BACKORDER_REDUCED = "Minoration"
BACKORDER_OTHER = "Autre"

# Reject reasons, first that holds wins.
REASON_ARTICLE = "Missing article"
REASON_EMPLOYEE = "Missing employee"
REASON_SHOP = "Missing shopid"

# Text format of load times.
TS_TEXT = "yyyy-MM-dd HH:mm:ss"
ISO_MILLIS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
