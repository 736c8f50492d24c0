"""Fixed values of the budget domain: codes, names, wordings and display orders."""

# --- fixed values: the general fund -------------------------------------------------
GENERAL_FUND_ID = 1001
GENERAL_FUND_NAME = "General"

# --- fixed values: objects shown together as employee costs --------------------------
EMPLOYEE_OBJECT_IDS = (1, 2)
EMPLOYEE_OBJECT_NAMES = ("Salaries", "Other Personnel Costs")
EMPLOYEE_OBJECT_ID = 1
EMPLOYEE_OBJECT_LABEL = "All Employee Costs"
EMPLOYEE_OBJECT_DISPLAY = "1, 2"

# --- fixed values: label of an object row without any budget line --------------------
NO_LINES_LABELS = {
    0: "No Transfers",
    1: "No Employee Costs",
    3: "No Contractual Services",
    4: "No Materials and Supplies",
    5: "No Equipment < $5K",
    6: "No Equipment > $5K",
    7: "No Grants, Subsidies or Contributions",
    8: "No Debt Service",
    9: "No Capital Improvements",
}

# --- fixed values: kinds of position change, in display order ------------------------
CHANGE_TYPES = (
    "create",
    "service_to",
    "service_from",
    "fund_to",
    "fund_from",
    "eliminate",
    "reclass_to",
    "fund_non_gf",
)

# --- fixed values: display order of funds (a missing fund comes next, others last) ---
FUND_ORDER = (
    "General",
    "Internal Service",
    "Federal",
    "State",
    "Special Grant",
    "Special Revenue",
    "Parking Management",
    "Conduit Enterprise",
    "Stormwater Utility",
    "Wastewater Utility",
    "Convention Center Bond",
    "Loan and Guarantee Enterprise",
    "Motor Vehicle",
)

# --- fixed values: cost-driver bucket of each subobject ------------------------------
DRIVER_BUCKETS = {
    "Permanent Wages Adjustment": ("101", "161", "162"),
    "Pension Adjustment": ("202", "203", "204", "279"),
    "Healthcare Adjustment": ("205", "285"),
    "Fleet Adjustment": ("331", "335", "401"),
    "Building Maintenance and Rental Charge Adjustment": ("396",),
}
OTHER_DRIVERS = "Other"

# --- fixed values: fund columns of the wide line summary -----------------------------
SUMMARY_FUNDS = {
    1001: "General Fund",
    2000: "Internal Service",
    2024: "Conduit Enterprise",
    2070: "Wastewater Utility",
    2071: "Water Utility",
    2072: "Stormwater Utility",
    2075: "Parking Enterprise",
    2076: "Parking Management",
    4000: "Federal",
    4001: "ARPA",
    5000: "State",
    6000: "Special Revenue",
    7000: "Special Grant",
}

# --- fixed values: other-personnel-cost codes of the position report -----------------
OPC_CODES = (201, 202, 203, 205, 207, 210, 212, 213, 231, 233, 235)

# --- fixed values: months of the expenditure report, fiscal-year order ---------------
MONTHS = {
    "jul": "July",
    "aug": "August",
    "sep": "September",
    "oct": "October",
    "nov": "November",
    "dec": "December",
    "jan": "January",
    "feb": "February",
    "mar": "March",
    "apr": "April",
    "may": "May",
    "jun": "June",
}

# --- fixed values: budget phases in the order they happen ----------------------------
PHASE_ORDER = ("CLS", "Proposal", "TLS", "FinRec", "BoE", "COU")

# --- fixed values: services always kept on the allow list ----------------------------
EXTRA_SERVICES = ("833", "619", "168")

# --- fixed values: markers and placeholders of a completed sheet ---------------------
TECHNICAL_TITLE = "Technical Adjustments"
SAVINGS_TITLE = "Savings Ideas"
TOTAL_MARKER = "Total"
PLACEHOLDERS = ("Enter item here", "Item", "Total")
PENDING = "Pending"
TLS_LABEL = "TLS Adjustments"

# --- fixed values: when a change counts as significant -------------------------------
SIGNIFICANT_AMOUNT = 5000
SIGNIFICANT_SHARE = 0.2
