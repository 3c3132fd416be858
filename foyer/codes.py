"""Fixed codes of the ticketing data model.

Fixed values: they mean the same thing in every installation's data, so the
numbers and texts below must stay as they are.
"""

# Price categories of a price map.
PRICE_NETT = 1
PRICE_GST = 3

# A price map that describes real seats carries this designation.
DESIGNATION_SEAT = 1

# Seat types left out of capacity.
SEAT_TYPE_STANDING = 3
SEAT_TYPE_WHEELCHAIR = 8

# Current state of a seat.
SEAT_AVAILABLE = (0, 3)
SEAT_BLACKOUT = 6
SEAT_RESERVED = 7
SEAT_RESERVED_PAID = 8
SEAT_TICKETED = 13
SEAT_PAID = (SEAT_RESERVED_PAID, SEAT_TICKETED)
SEAT_SOLD_OR_HELD = (SEAT_RESERVED_PAID, SEAT_TICKETED, SEAT_RESERVED)

# Seat history events.
EVENT_RESERVED = 1
EVENT_RETURNED = 3
EVENT_RELEASED = 4
EVENT_PAID = 26
EVENT_UNPAID = 27
EVENTS_COUNTED = (EVENT_PAID, EVENT_UNPAID, EVENT_RETURNED, EVENT_RELEASED, EVENT_RESERVED)

# Hold code types.
HOLD_VENUE_ADMIN = 1
HOLD_PROMOTER = 3
HOLD_VENUE_CONTRACT = 4
HOLD_CONSIGNMENT = 5
HOLD_PRODUCTION = 6
HOLDS = (HOLD_VENUE_ADMIN, HOLD_PROMOTER, HOLD_VENUE_CONTRACT, HOLD_PRODUCTION)

# Import: constants written with every loaded row.
ORIGINAL_SOURCE = 4
LEGACY_KEYWORD = 404
CONSTITUENCY_TICKET_BUYER = 3
INTERESTS = (9, 14)
HISTORY_ROLE = 7
HISTORY_PERF_NO = -1
HISTORY_MOS = 8
HISTORY_TYPE = "P"
HISTORY_SEASON = 2
HISTORY_PKG_NO = 0
HISTORY_COMP_CODE = 0
HISTORY_ORDER_NO = 0
HISTORY_THEATER_NO = 4

# Import: opt-out texts, dead e-mail results, marketing indicators.
PRESENTER_OPT_OUT = "Yes"
DECLINE_OPT_OUT = "Do Not Email"
DEAD_EMAIL_RESULTS = ("unreachable", "illegitimate")
MARKETING_OPT_OUT_EMAIL = 2
MARKETING_ALLOWED = 4

# Import: value corrections.
PREFIX_FIXES = {"Dr": "Dr.", "Mrs": "Mrs.", "Mr": "Mr.", "Ms": "Ms."}
STATE_NOT_A_STATE = "London"

# Import: longest text the target accepts.
LENGTH_LIMITS = {"fname": 20, "lname": 55, "street1": 64, "street2": 64, "city": 30}

# Import: phone numbers that are really mobiles.
MOBILE_PREFIX = "04"
MOBILE_PHONE_TYPE = 5
LANDLINE_PHONE_TYPES = (1, 2)
HOME_COUNTRY = 227
IMPORT_USER = "dbo"

# A word starts after any of these characters.
WORD_DELIMITERS = " ;:!?,._-/&'("

# Cart: action codes.
ACTIONS = {
    1: "single_added",
    2: "aux_single_added",
    3: "subscription_added",
    4: "aux_subscription_added",
    5: "renewal_added",
    6: "aux_renewal_added",
    7: "contribution_added",
    8: "cart_deletion",
    9: "checkout",
    10: "login",
    100: "preselected_perfs",
}
ACTION_DISCOUNT = 901
ACTION_DISCOUNT_SPAN = 999_999_999
ACTION_GIFT = 1_900_000_000
ACTION_GIFT_SPAN = 99_999_999
GIFT_USE_STORED = 99_999_999
GIFT_MIN, GIFT_MAX = 1, 999_999

# Cart: gift ask level by cart total (total below -> level), and above the last.
ASK_LEVELS = ((100, 10), (350, 20), (750, 50), (100_000, 100))
ASK_LEVEL_ABOVE = 10

# Cart: content types of the configuration table.
CONTENT_RULES_MOS = "Rules_MOS"
CONTENT_MATINEE_MOS = "Matinee_MOS"
CONTENT_THREE_OR_MORE = "3_or_more_PTG"
CONTENT_LESS_THAN_THREE = "Less_than3_PTG"
CONTENT_PRESELECTED = "Pre_Selected_Perfs"
CONTENT_CONTINUE = "Continue_Shopping"
CONTENT_FINISHED = "Finished_Shopping"
CONTENT_LIMIT_MESSAGE = "Checkout_Limit_Msg"
CONTENT_ROUND_UP = "Round_Up_Msg"
SHOWS_FOR_PACKAGE = 3

# Cart: names of session variables.
VAR_USER_NAME = "UserName"
VAR_MOS_CHANGED_FROM = "MOS_Changed_From"
VAR_GIFT_ASKED = "Gift_Asked"
VAR_ROUND_UP = "Round_Up"
VAR_PRESELECTED_LOOP = "PreSelected_Perfs_Loop"
VAR_PRESELECTED_FINISHED = "Finished_PreSelected_Perf_"
LOOP_ACTIVE = "ACTIVE"
LOOP_FINISHED = "OK"
ASKED_ONCE = "1"
ASKED_FOR_GOOD = "2"

# Cart: inventory content types.
INV_CALENDAR_IMAGE = 8
INV_PRODUCTION_IMAGE = 9
INV_SYNOPSIS = 11
INV_SEASON_IMAGE = 17

# Default texts where the configuration has none.
DEFAULT_SELECT_BUTTON = "  Select  "
DEFAULT_SELECT_MESSAGE = "Please make your ticket selection below."
DEFAULT_SELECT_DONE = "I don't wish to make any further selections."
DEFAULT_CONTINUE_BUTTON = "Continue Shopping"
DEFAULT_CONTINUE_TEXT_BLOCKED = "Click to Continue Shopping"
DEFAULT_CONTINUE_TEXT = "Continue Shopping"
DEFAULT_FINISHED_BUTTON = "Finished"
DEFAULT_FINISHED_TEXT = "Proceed to Checkout"
DEFAULT_GIFT_LABEL = "Round Up Your Order to"

# Open ends of a date range.
RANGE_MIN = "1900-01-01"
RANGE_MAX = "2099-12-31"
CONTENT_MIN = "2000-01-01"
CONTENT_MAX = "2100-12-31"
CONTENT_LAST_DAY_HOURS = 23
