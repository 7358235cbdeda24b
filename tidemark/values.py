"""Fixed values.

Everything in this file is data that results depend on: vocabularies, text
patterns, thresholds and column lists. No logic lives here.
"""

# --- event vocabulary -----------------------------------------------------
EVENT_TYPES = [
    "page_view", "product_view", "add_to_cart", "remove_from_cart",
    "checkout_start", "checkout_complete", "purchase", "search",
    "wishlist_add", "promo_click", "session_start", "session_end",
]
LITE_EVENT_TYPES = [
    "page_view", "product_view", "add_to_cart", "remove_from_cart",
    "checkout_start", "purchase", "search", "session_start",
]
FUNNEL_STEPS = ["product_view", "add_to_cart", "checkout_start", "purchase"]
EARLIEST_EVENT = "2020-01-01"
SILVER_VERSION = "2.4.1"

# --- text patterns --------------------------------------------------------
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:?\d{2})?$"
EPOCH_MILLIS = r"^\d{13}$"
EPOCH_SECONDS = r"^\d{10}$"
URL_HOST = r"^(?:https?://)?([^/?#]+)"
URL_PATH = r"^(?:https?://)?[^/?#]+(/[^?#]*)"
SEARCH_HOSTS = r"google|bing|yahoo|duckduckgo"
SOCIAL_HOSTS = r"facebook|instagram|twitter|tiktok|linkedin"
IPV4 = r"^\d{1,3}(\.\d{1,3}){3}$"
IPV4_LAST_OCTET = r"\.\d+$"
IPV6 = r"^[0-9a-fA-F]{0,4}(:[0-9a-fA-F]{0,4}){2,7}$"
CURRENCY_MARKS = r"[€$£]|EUR|USD|GBP|\s"

# --- referrer channels ----------------------------------------------------
CHANNELS = ["direct", "organic_search", "social", "internal", "referral"]

# --- order status words, by normalised status -----------------------------
ORDER_STATUS_WORDS = {
    "confirmed": ["paid", "confirmed", "validé"],
    "shipped": ["shipped", "expédié", "versandt"],
    "delivered": ["delivered", "livré", "geliefert"],
    "cancelled": ["cancelled", "annulé", "storniert"],
    "refunded": ["refunded", "remboursé", "zurückerstattet"],
}
ORDER_STATUS_DEFAULT = "pending"
ORDER_STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled", "refunded"]
EARLIEST_ORDER = "2020-01-01"

# --- thresholds -----------------------------------------------------------
CHURN_HIGH = 0.7
CHURN_MEDIUM = 0.4
CHURN_DEFAULT = 0.5
HIGH_VALUE_EUR = 1000
TAX_RATE = "0.20"
BOUNCE_SECONDS = 30
MEDIAN_ACCURACY = 100_000  # rank error of a median: at most 1 in this many rows
LOOKBACK_DAYS = 3
LOW_ORDER_VOLUME = 100
LANDING_MIN_FILES = 500
LANDING_MIN_BYTES = 50 * 1024**3
SILVER_MIN_ROWS = 500_000_000
SILVER_MAX_ROWS = 5_000_000_000
REVENUE_MAX_EUR = 50_000.0
ORDER_REVENUE_MAX_EUR = 100_000
FRESH_HOURS = 8
SOURCE_FRESH_WARN_HOURS = 6
SOURCE_FRESH_ERROR_HOURS = 12
FIRST_MARK = "2020-01-01 00:00:00"
UNKNOWN_KEY = "-1"
NULL_KEY_MARKER = "_dbt_utils_surrogate_key_null_"

# --- landing --------------------------------------------------------------
LANDING_ROWS_PER_FILE = {"messages": 100_000, "api": 50_000, "documents": 5_000, "queue": 1_000}
LANDING_FLUSH_SECONDS = 300

# --- calendar -------------------------------------------------------------
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"
FRENCH_HOLIDAYS = ["01-01", "05-01", "05-08", "07-14", "08-15", "11-01", "11-11", "12-25"]
COMMERCIAL_PERIODS = {
    "black_friday_week": ("11-25", "11-30"),
    "christmas_peak": ("12-10", "12-31"),
    "winter_sales": ("01-08", "01-18"),
    "summer_sales": ("06-25", "07-10"),
}
COMMERCIAL_DEFAULT = "standard"

# --- Silver contract columns ----------------------------------------------
SILVER_COLUMNS = [
    "event_id", "session_id", "user_id", "anonymous_id",
    "event_type", "event_ts", "event_date",
    "page_url", "page_domain", "page_path",
    "device_type", "os", "browser",
    "country_code", "ip_anonymized",
    "referrer_channel", "revenue_eur", "has_revenue",
    "_silver_processed_at", "_silver_version", "_processing_date",
]
DEVICE_TYPES = ["desktop", "mobile", "tablet"]

# --- customer and profile vocabularies ------------------------------------
PROFILE_COUNTRIES = ["FR", "DE", "ES", "GB", "IT", "BE", "NL", "CH", "PT", "PL"]
PROFILE_SEGMENTS = ["VIP", "Loyal", "New", "Lapsed", "At-Risk"]
CHURN_BANDS = ["low", "medium", "high"]
PAYMENT_METHODS = ["card", "paypal", "bank_transfer", "apple_pay"]
CUSTOMER_SEGMENTS = ["high_value", "mid", "low", "churned"]
LOYALTY_TIERS = ["gold", "silver", "bronze"]

# --- profile documents ----------------------------------------------------
PROFILE_FIELDS = [
    "user_id", "email", "first_name", "last_name",
    "country_code", "city", "customer_segment", "loyalty_tier",
    "acquisition_channel", "acquisition_date",
    "preferred_category", "preferred_device",
    "ltv_estimate_eur", "predicted_churn_score",
    "profile_completeness_pct", "last_active_at",
    "phone", "address", "consents", "tags",
    "updated_at", "created_at",
]
PII_FIELDS = ["phone", "address"]
PROFILE_COLLECTIONS = ["profiles", "events_meta", "consents"]

# --- attributes whose change opens a new customer version -----------------
CUSTOMER_TRACKED = [
    "email_hashed", "first_name", "last_name", "country_code",
    "city", "customer_segment", "loyalty_tier", "phone_hash",
]

# --- synced streams: name -> (primary key, cursor) -------------------------
PROFILE_STREAMS = {
    "profiles": ("_id", "updated_at"),
    "events_meta": ("user_id", "updated_at"),
    "consents": ("user_id", "updated_at"),
}
CRM_STREAMS = {
    "Account": ("Id", "SystemModstamp"),
    "Contact": ("Id", "SystemModstamp"),
    "Opportunity": ("Id", "SystemModstamp"),
    "Lead": ("Id", "SystemModstamp"),
}

# --- event message contract -----------------------------------------------
CONTRACT_REQUIRED = ["event_id", "event_type", "event_timestamp"]
CONTRACT_PATTERNS = {
    "event_id": r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$",
    "country_code": r"^[A-Z]{2}$",
}
CONTRACT_ENUMS = {"event_type": EVENT_TYPES, "device_type": DEVICE_TYPES}
CONTRACT_MIN_LENGTH = {"session_id": 1}
CONTRACT_MAX_LENGTH = {"page_url": 2048, "referrer_url": 2048}
CONTRACT_ANY_OF = ["user_id", "anonymous_id"]
