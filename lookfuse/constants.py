"""Names shared by every module."""

# The status column and its codes are part of the output contract.
STATUS_COLUMN = "__enrichment_status"
STATUS_SUCCESS = "SUCCESS"
STATUS_NO_MATCH = "NO_BQ_DATA"
STATUS_DECLINED = "BQ_SELECTION_FAILED"
INVALID_CACHE_KEY = "__invalid_key__"

MATCH_COUNT_COLUMN = "__match_count"

# Internal column prefixes. No column of either side may start with any of them.
VALUE_PREFIX = "__rqv_"  # condition values
FIELD_PREFIX = "__rqf_"  # request fields read by a restriction function or selector
KEY_PREFIX = "__rqk_"  # request side of the equality keys
BOUND = "__rqb"  # request side of the range comparison
LIMIT = "__rqt"  # request side of the second bound on the same lookup column
LOOKUP_KEY_PREFIX = "__lkk_"
LOOKUP_BOUND = "__lkb"
LOOKUP_PREFIX = "__lk_"  # selected lookup columns, after renaming
ORDER_PREFIX = "__ord_"
HIT = "__hit"
CHOSEN = "__chosen"
COUNT = "__n_matches"
SALT = "__salt"

RESERVED_PREFIXES = (
    VALUE_PREFIX,
    FIELD_PREFIX,
    KEY_PREFIX,
    BOUND,
    LIMIT,
    LOOKUP_KEY_PREFIX,
    LOOKUP_BOUND,
    LOOKUP_PREFIX,
    ORDER_PREFIX,
    HIT,
    CHOSEN,
    COUNT,
    SALT,
)
