"""Fixed values that must equal the source jobs' values for identical results.

Everything here is data, not logic: the operators read these lists and maps.
"""

# --- fixed values: transaction feeds -------------------------------------
# Columns missing in feed C, padded with ''.
FEED_C_MISSING = ["paperNum", "due", "jour", "merch", "location", "bCode"]
# Columns padded with '' on every feed.
BATCH_PAD = ["accCatDets", "accDisWhenCreate", "accLim", "accN", "bookedAmt", "isHidden"]
# Output rename map for feeds A and C (source name -> output name).
OUTPUT_RENAMES = {
    "cat_id": "catId",
    "cat_N": "catN",
    "cat_type": "catType",
    "Var": "isCat",
    "SubText_Created": "subTCreate",
    "sub_text": "subtext",
    "Final_Output": "Output",
    "detection": "detectedCat",
}
# Feed B default category by sign of the amount: (catId, catN, catType).
DEFAULT_CAT_NEGATIVE = ("956", "OP (T)", "Exp")
DEFAULT_CAT_OTHER = ("953", "OI", "Exp")
# Feed B output padding, in order; isCat is a single blank.
FEED_B_PAD = {
    "det_Cat": "",
    "acc": "",
    "subTCreate": "",
    "merchN": "",
    "subtext": "",
    "isCat": " ",
    "catOut": "",
    "hasUncertainCat": "",
}

# --- fixed values: categorization ----------------------------------------
# Columns that must all be present for a message to be categorized.
REQUIRED_COLUMNS = ["accIdent", "tranDt", "cost", "tranT", "tranI"]
# Token separators and whitespace pattern.
TOKEN_SPLIT_PATTERN = "/|~"
WHITESPACE_PATTERN = "\\s+"
# Counterparty rules on the first token: (prefix pattern, token index or None for '').
COUNTERPARTY_TOKEN_RULES = [
    ("^U", None),
    ("^A", 1),
    ("^M", 3),
    ("^E", 2),
    ("^C", 1),
    ("^B", 1),
    ("^N", 2),
    ("^I", 3),
]
PAYTYPE_REMIT_PATTERN = "^remit"
PAYTYPE_BILL = "bill"
BILL_TOKEN = "AP"
PAYTYPE_OTHERS = "others"
OTHERS_TEXT_PATTERN = "^(C|I|S)"
# User-decision guard lists.
OTHERS_IDS = ["1", "119", "882", "444"]
IN_CAT_IDS = ["1", "2", "3", "657", "786", "898"]
DECISION_WEIGHT = 1.5
CATEGORY_ID_SEPARATOR = "-"

# --- fixed values: status dashboard --------------------------------------
STATUS_CODES = ["OK", "DBA", "DLT", "FIN", "PRX", "SFD", "CBS", "PRM", "SRC", "TGT"]
SUCCESS_CODE = "OK"
DELAY_CODE = "DLT"
MONTHLY_FREQUENCIES = ["MLY_01", "MLY_21", "MLY_25", "MLY_16", "MLY_26", "MLT_15", "DLY_MLY_16"]
COLOUR_OK = "#9FE2BF"
COLOUR_DELAY = "#FFBF00"
COLOUR_OTHER_CODE = "#FFFF00"
OTHER_COLOURED_CODES = ["DBA", "FIN", "PRX", "SFD", "CBS", "PRM", "SRC", "TGT"]
FAILURE_MARKER = "SUCCESS"
CELL_OPEN = '<td class="y_n">'
CELL_CLOSE = "</td>"

# --- fixed values: table transfer ----------------------------------------
MANIFEST_COLUMNS = [
    "PROCESS_NAME", "DATAFRAME_NAME", "SOURCE_TYPE", "DEST_TABLE_NAME", "DEST_WRITE_MODE",
    "DEST_AUDIT_TABLENAME", "M_INDICATOR", "STORAGE_LOCATION", "COLUMN_LIST", "WHERE_CLAUSE",
]
MANIFEST_DELIMITER = "|"
PROCESS_KEY_SEPARATOR = "~"
LOG_SEPARATOR = "~#~"
LOG_EXPORT_SEPARATOR = "~"
LOG_FIELDS = ["log_id", "source", "empty1", "empty2", "table_name", "stage", "status",
              "empty3", "message", "log_ts", "log_date"]
COMPLETION_MARKER = "Data Transfer Successful :"
MARKER_PREFIX = "success"
READY_ON_MARKER_INDICATOR = "t"
BASE_PATH_INDICATOR = "m"
# Processes that read yesterday's dated folder instead of today's.
PREVIOUS_DAY_PROCESSES = ("ON~CC~30",)
AUDIT_STARTED = "Started"
AUDIT_FINISHED = "Finished"

# --- fixed values: cluster report ----------------------------------------
REPORT_COLUMNS = [
    "Username", "ClusterId", "NormalizedInstanceHours", "runtime", "State", "idle_pct",
    "idle_pct_12h", "idle_pct_3h", "ApproxCost", "ReadyDateTime", "CreationDateTime", "EndDateTime",
]
# Header names of the written report for the idle columns.
REPORT_DISPLAY_NAMES = {
    "idle_pct": "idle%",
    "idle_pct_12h": "idle% in last 12hours",
    "idle_pct_3h": "idle% in last 3hours",
}
NO_RESPONSE_ELEMENTS = "No responseElements"
DEFAULT_CLUSTER_STATES = ["WAITING"]
INFO_DAYS = 30

# audit event that starts a cluster
LAUNCH_EVENT = "RunJobFlow"
