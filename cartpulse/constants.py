"""Fixed values that must equal the original system's for identical results."""

# Stream, topic and table names are parameters of the readers and writers.

# --- fixed values: event classes used by the coupon alert ---
EVID_COUPON = "coupon"
EVID_CLICK_ITEM = "clickItem"
ALERT_MIN_ACCOUNTS = 3
ALERT_WINDOW = "5 minutes"
ALERT_SLIDE = "5 seconds"
ALERT_ID_BUCKET_MS = 60000  # one alert document per device per minute

# --- fixed values: change-log filter ---
CDC_ENTRY_ROWDATA = "ROWDATA"
CDC_ORDER_TABLE = "order_info"
CDC_INSERT = "INSERT"

# --- fixed values: dashboard KPI rows (id, display name) ---
KPI_DAU = ("dau", "新增日活")
KPI_NEW_MID = ("new_mid", "新增设备")
KPI_ORDER_AMOUNT = ("order_amount", "新增交易额")

# --- fixed values: sale-detail page ---
AGE_BAND_LABELS = ("20岁以下", "20-30岁", "30岁以上")
AGE_BAND_EDGES = (20, 30)
PROVINCE_CLASS_WIDTH = 100
PROVINCE_CLASS_MAX = 600
