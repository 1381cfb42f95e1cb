"""Fixed values of the feedback-triage domain.

Everything in this module must hold exactly for results to be right: value
domains, default tables, quotas, message texts and output formats. They are
data, not logic, and are kept together here in their natural order.
"""

# --- value domains -----------------------------------------------------------
CATEGORIES = ["Bug", "Feature Request", "Praise", "Complaint", "Spam"]
PRIORITIES = ["Critical", "High", "Medium", "Low"]
SEVERITIES = ["Critical", "High", "Medium", "Low"]
IMPACTS = ["High", "Medium", "Low"]
SOURCE_TYPES = ["review", "email"]

FALLBACK_CATEGORY = "Complaint"
FALLBACK_SEVERITY = "Medium"
FALLBACK_IMPACT = "Medium"
SKIPPED_CATEGORIES = ["Praise", "Complaint", "Spam"]

CONFIDENCE_THRESHOLD = 0.7
DEFAULT_PRIORITY = {
    "Bug": "High",
    "Feature Request": "Medium",
    "Complaint": "Low",
    "Praise": "Low",
    "Spam": "Low",
}
FALLBACK_PRIORITY = "Low"

# --- feature requests: demand score -> priority ------------------------------
DEMAND_MIN = 1
DEMAND_MAX = 10
DEMAND_DEFAULT = 5
DEMAND_HIGH = 8
DEMAND_MEDIUM = 5

# --- "nothing known" markers -------------------------------------------------
UNKNOWN = "Unknown"
NOT_SPECIFIED = "Not specified"

# --- tickets -----------------------------------------------------------------
TITLE_MAX = 80
TITLE_MIN = 10
DESCRIPTION_MIN = 20
TICKET_ID_FORMAT = "T%04d"
TICKET_COLUMNS = [
    "ticket_id", "source_id", "source_type", "title", "description",
    "category", "priority", "technical_details", "created_at",
]
REQUIRED_FIELDS = ["source_id", "source_type", "title", "description", "category", "priority"]

# --- quality messages --------------------------------------------------------
MSG_MISSING_FIELD = "Missing required field: '%s'"
MSG_TITLE_SHORT = "Title too short (%d chars, min 10)"
MSG_DESCRIPTION_SHORT = "Description too short (%d chars, min 20)"
MSG_BAD_CATEGORY = "Invalid category: '%s'"
MSG_BAD_PRIORITY = "Invalid priority: '%s'"
MSG_BUG_DETAILS = "Bug ticket is missing technical_details"

# --- processing log ----------------------------------------------------------

# --- response text -----------------------------------------------------------
FENCE_PATTERN = r"(?s)```(?:json)?\s*(.*?)```"
# from the first brace to the next closing one; without a lazy quantifier the
# match needs a single pass
OBJECT_PATTERN = r"\{[^}]*\}"

# Every code point that counts as whitespace when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- synthetic data: quotas, rating and priority draws -----------------------
REVIEW_QUOTA = [
    ("Bug", 0.30), ("Feature Request", 0.25), ("Praise", 0.20),
    ("Complaint", 0.15), ("Spam", 0.10),
]
EMAIL_QUOTA = [("Bug", 0.6), ("Feature Request", 0.4)]
RATINGS = {
    "Bug": [1, 1, 2],
    "Feature Request": [3, 3, 4],
    "Praise": [4, 5, 5],
    "Complaint": [1, 2, 2, 3],
    "Spam": [1, 3, 5],
}
EMAIL_PRIORITIES = {
    "Bug": ["High", "High", "Medium", "Critical", ""],
    "Feature Request": ["Low", "Medium", ""],
}
# percent per priority, in the order Critical, High, Medium, Low
LABEL_PRIORITY_PERCENT = {
    "Bug": [15, 45, 30, 10],
    "Feature Request": [0, 10, 50, 40],
    "Praise": [0, 0, 20, 80],
    "Complaint": [5, 30, 45, 20],
    "Spam": [0, 0, 0, 100],
}
REVIEW_DAYS_BACK = 180
EMAIL_DAYS_BACK = 90
REVIEW_ID_FORMAT = "REV%05d"
EMAIL_ID_FORMAT = "EML%05d"
LABEL_TITLES = {
    "Bug": "[Bug] App fails to ",
    "Feature Request": "Feature Request",
    "Praise": "[Praise] Positive user feedback",
    "Complaint": "[Complaint] Negative user experience reported",
    "Spam": "[Spam] Flagged for removal",
}
