"""Values that decide results, kept in one place."""

# ---- Fixed values: domains, thresholds and limits the results depend on ----

OSES = ("Windows_NT", "Darwin", "Linux")

# Inclusive sample_id bounds per channel; None is an open end. Channels not listed are dropped.
SAMPLE_BOUNDS = {
    "release": (1, 1),
    "esr": (None, 25),
    "beta": (None, 50),
    "aurora": (None, None),
    "nightly": (None, None),
}

# How many days before the submission date a build is still counted under its own id.
LAG_DAYS_ESR = 365 * 3
LAG_DAYS_RELEASE_LINUX = 365 * 2
LAG_DAYS_BETA = 100
LAG_DAYS_OTHER = 60

FOLD_SHARE = 0.005          # a row must exceed this share of its day to keep its version
FOLD_LABEL = "other"
FOLD_OFFSET_DAYS = 1        # extra lag of the build id that folded rows get

FIRST_DAY_SHARE = 0.01      # a version "starts" on the first day above this share
LOOKBACK_DAYS = 11 * 30     # counts read by the curve job
OLD_BUILD_LENGTH = 8        # floored build ids are yyyyMMdd; real ones are longer

CURVE_CHANNELS = ("release", "beta", "aurora", "nightly")
UNCURVED_CHANNELS = ("esr",)                                         # counted, but without curves
CURVE_MONTHS = {"release": 7, "beta": 3, "aurora": 3, "nightly": 3}   # months of 30 days
DISPLAY_DAYS = {"release": 30, "beta": 10, "nightly": 7, "aurora": 10}
DISPLAY_FLOOR = -2          # days after release must exceed this

TOP_VERSIONS = {"release": 20, "beta": 30, "aurora": 30, "nightly": 40}
TOP_VERSIONS_PRODUCTION = {"release": 12, "beta": 18, "aurora": 18, "nightly": 30}
SLIDER_VERSIONS = 10

RELEASE_CATEGORIES = ("major", "stability")
DEV_CATEGORY = "dev"
ESR_SUFFIX = "esr"

REGISTRY_PLATFORM = "win64"
REGISTRY_LOCALE = "en-US"
REGISTRY_WINDOW_DAYS = 12 * 30

NIGHTLY_FIRST_DAY = "201909"
NIGHTLY_CLAMP_DAY = "20190101"

# Version patterns.
RELEASE_PATTERN = r"^(\d+)\.\d+$"
RC_PATTERN = r"^(\d\d+)(\.\d)+$"
DATE_PREFIX_PATTERN = r"^\d{4}-\d{2}-\d{2}"
