"""Fixed values of the complaint domain.

Labels, dates and cut points that results depend on. Every operator takes them as arguments;
these are the defaults.
"""

from plaintlens.functions.flags import Era

# Collection windows of two source fields.
DISPUTE_ERA = Era("dispute", end="2017-04-24")
NARRATIVE_ERA = Era("narrative", start="2015-06-01")
FULL_YEARS = (2012, 2022)
DATE_RANGE = ("2011-01-01", "2023-12-31")
INTAKE_ARTIFACT_END = "2014-04-26"

# Sentinels and label rewrites.
NOT_PROVIDED = "not-provided"
NO_RESPONSE = "Untimely response"
STATE_ALIASES = {"UNITED STATES MINOR OUTLYING ISLANDS": "UM"}
TAGS = {
    "tags_is_servicemember": "Servicemember",
    "tags_is_older_american": "Older American",
}
PUBLIC_RESPONSE_LABELS = {
    "Company has responded to the consumer and the CFPB and chooses not to provide a public response":
        "Company chooses not to provide a public response",
}
VEHICLE_PRODUCT = "Consumer Loan"
VEHICLE_SUBPRODUCTS = ["Vehicle loan", "Vehicle lease"]
VEHICLE_LABEL = "Vehicle loan or lease"

# Product and response roll-ups.
PRODUCT_CATEGORIES = {
    "Mortgage": "mortgage",
    "Credit reporting, credit repair services, or other personal consumer reports": "credit_reporting",
    "Debt collection": "debt_collection",
    "Checking or savings account": "banking",
    "Credit card or prepaid card": "card",
    "Money transfer, virtual currency, or money service": "payments",
}
MONETARY_RELIEF = "Closed with monetary relief"
RESPONSE_CATEGORIES = {
    "Closed with monetary relief": "relief",
    "Closed with non-monetary relief": "relief",
    "Closed with relief": "relief",
    "Closed with explanation": "explanation_only",
    "Closed without relief": "explanation_only",
    "Closed": "explanation_only",
}

# Routing-lag buckets (days), bank tiers (thousands of USD), branchless cut.
LAG_CUTS = [0, 3, 14]
LAG_LABELS = ["0_same_day", "1_to_3", "4_to_14", "15_plus"]
ASSET_CUTS = [1_000_000_000, 400_000_000, 175_000_000]
ASSET_LABELS = ["mega (>$1T)", "large ($400B-$1T)", "mid ($175B-$400B)", "smaller (<$175B)"]
PREVIEW_ASSET_CUTS = [250_000_000, 50_000_000, 10_000_000, 1_000_000]
PREVIEW_ASSET_LABELS = [
    "mega (>$250B)", "large ($50B-$250B)", "mid ($10B-$50B)", "regional ($1B-$10B)", "community (<$1B)",
]
BRANCHLESS_BELOW = 50
ANALYSIS_ERA_LABELS = ["pre_2015", "2015_2019", "2020_plus"]
GROUP_SIZE_CUTS = [1, 5, 20, 100, 1000]
GROUP_SIZE_LABELS = ["1", "2-5", "6-20", "21-100", "101-1000", "1001+"]

# Abbreviations expanded in holder display names, in this order.
HOLDER_REPLACEMENTS = [("&", " & "), ("BCORP", "BANCORP"), (" FINL ", " FINANCIAL ")]
HOLDER_SUFFIX = " THE"

# Legal suffixes removed before candidate matching, in this order.
LEGAL_SUFFIXES = [
    r"(INC\.?|INCORPORATED)",
    r"(LLC\.?|L\.L\.C\.?)",
    r"(CORP\.?|CORPORATION)",
    r"(N\.?A\.?|NATIONAL ASSOCIATION)",
    r"(&\s*CO\.?|AND\s+CO\.?|AND\s+COMPANY)",
    r"(HOLDINGS?|FINANCIAL|BANCORP|BANCSHARES?)",
]

# Implied entity type by name pattern, first match wins.
IMPLIED_CATEGORIES = [
    ("mortgage_servicer",
     r"MORTGAGE|HOME LOAN|LOAN SERVIC|SHELLPOINT|PENNYMAC|LOANCARE|RUSHMORE|CALIBER|FREEDOM|CARRINGTON"
     r"|SETERUS|BAYVIEW|COMMUNITY LOAN"),
    ("student_loan_servicer",
     r"STUDENT LOAN|NELNET|PHEAA|SALLIE MAE|GREAT LAKES|EDFINANCIAL"),
    ("debt_collector",
     r"COLLECTION|CREDIT SYSTEM|RECOVERY|TRANSWORLD|PORTFOLIO|ENCORE|RESURGENT|AFNI|DIVERSIFIED CONSULT"
     r"|CCS FINANCIAL|CL HOLDING|COMMONWEALTH FINANCIAL|NATIONAL CREDIT|SOUTHWEST CREDIT|WESTLAKE"),
    ("auto_lender",
     r"TOYOTA|HONDA|HYUNDAI|GENERAL MOTORS FINANCIAL|FORD MOTOR CREDIT|NISSAN|CREDIT ACCEPTANCE|WESTLAKE"),
    ("fintech",
     r"COINBASE|CHIME|PAYPAL|VENMO|SQUARE|STRIPE|KLARNA|AFFIRM|WESTERN UNION|MONEYGRAM"
     r"|FIDELITY NATIONAL INFO|FNIS"),
    ("bank",
     r"BANK|FINANCIAL CORP|FINANCIAL GROUP|BANCORP|CREDIT UNION|SAVINGS|FEDERAL SAVINGS"
     r"|NATIONAL ASSOCIATION|N\.A\b|FSB\b|HSBC|GOLDMAN|CITIBANK|BBVA|CITIZENS|COMERICA|KEYCORP|REGIONS"
     r"|FLAGSTAR"),
]

# Postcode shapes, first match wins ('' and NULL are named separately).
ZIP_PATTERNS = [
    ("valid_5digit", r"^[0-9]{5}\z"),
    ("4digit_leading_zero_dropped", r"^[0-9]{4}\z"),
    ("masked_5char", r"^[0-9X]{5}\z"),
    ("zip_plus4_dash", r"^[0-9]{5}-[0-9]{4}\z"),
    ("zip_plus4_nodash", r"^[0-9]{9}\z"),
]

# Legacy product labels that must not survive normalisation.
LEGACY_PRODUCTS = [
    "Bank account or service", "Consumer Loan", "Credit card", "Credit reporting",
    "Money transfers", "Payday loan", "Prepaid card", "Virtual currency",
]

# Labels the checks accept.
PRODUCTS = [
    "Bank account or service",
    "Checking or savings account",
    "Consumer Loan",
    "Credit card",
    "Credit card or prepaid card",
    "Credit reporting",
    "Credit reporting, credit repair services, or other personal consumer reports",
    "Debt collection",
    "Money transfer, virtual currency, or money service",
    "Money transfers",
    "Mortgage",
    "Other financial service",
    "Payday loan",
    "Payday loan, title loan, or personal loan",
    "Prepaid card",
    "Student loan",
    "Vehicle loan or lease",
    "Virtual currency",
]
CHANNELS = ["Email", "Fax", "Phone", "Postal mail", "Referral", "Web", "Web Referral"]
COMPANY_CATEGORIES = [
    "bank", "credit_bureau", "credit_union", "debt_collector", "mortgage_servicer", "student_loan_servicer",
    "fintech", "other",
]
ISSUE_CATEGORIES = [
    "credit_reporting", "debt_collection", "payment_servicing", "account_management", "transactions_fees",
    "application_origination", "fraud_identity_theft", "other",
]
STATES = [
    "AA", "AE", "AK", "AL", "AP", "AR", "AS", "AZ", "CA", "CO", "CT", "DC", "DE", "FL", "FM", "GA",
    "GU", "HI", "IA", "ID", "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MH", "MI", "MN", "MO",
    "MP", "MS", "MT", "NC", "ND", "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA", "PR",
    "PW", "RI", "SC", "SD", "TN", "TX", "UT", "VA", "VI", "VT", "WA", "WI", "WV", "WY", "UM",
    "not-provided",
]
