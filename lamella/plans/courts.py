"""Fixed values of the six state court feeds and of the federal feed."""

from __future__ import annotations

from lamella.specs import CourtMapping

# Columns, county and date format of each court's feed.
COURTS = [
    CourtMapping(
        "TX",
        {
            "case_number": "case_number", "filing_date": "file_date", "case_type_raw": "case_type",
            "case_status_raw": "case_status", "plaintiff_name": "plaintiff_name",
            "defendant_name": "defendant_name", "judge_name": "judge", "amount_demanded": "amount",
            "cause_of_action": "cause_of_action",
        },
        "MM/dd/yyyy", "Harris County",
    ),
    CourtMapping(
        "CA",
        {
            "case_number": "docket_id", "filing_date": "filing_date", "case_type_raw": "case_type_code",
            "case_status_raw": "status", "court_name": "court_division",
            "amount_demanded": "amount_controversy",
        },
        "yyyy-MM-dd", "Los Angeles County", nested_parties="parties", nested_disposition="disposition",
    ),
    CourtMapping(
        "NY",
        {
            "case_number": "index_number", "filing_date": "date_filed", "case_type_raw": "action_type",
            "case_status_raw": "status", "plaintiff_name": "plaintiff", "defendant_name": "defendant",
            "judge_name": "judge_assigned", "amount_demanded": "relief_sought",
            "disposition_date": "disposition_date", "county": "county",
        },
        "MM/dd/yyyy",
    ),
    CourtMapping(
        "FL",
        {
            "case_number": "case_id", "filing_date": "filed_dt", "case_type_raw": "case_type",
            "case_status_raw": "case_status", "court_name": "division", "plaintiff_name": "pty_plaintiff",
            "defendant_name": "pty_defendant", "judge_name": "judge_name", "amount_demanded": "amt_claimed",
            "disposition_date": "disp_dt", "disposition": "disp_type",
        },
        "yyyyMMdd", "Miami-Dade County", zero_is_null=True,
    ),
    CourtMapping(
        "IL",
        {
            "case_number": "case_number", "filing_date": "filing_date", "case_type_raw": "case_category",
            "case_status_raw": "case_status", "court_name": "court_room", "plaintiff_name": "plaintiff_info",
            "defendant_name": "defendant_info", "judge_name": "presiding_judge",
            "amount_demanded": "demand_amount",
        },
        "dd-MMM-yyyy", "Cook County",
    ),
    CourtMapping(
        "OH",
        {
            "case_number": "case_num", "filing_date": "file_dt", "case_type_raw": "type_cd",
            "case_status_raw": "status_cd", "plaintiff_name": "plaintiff_nm",
            "defendant_name": "defendant_nm", "judge_name": "judge_nm", "amount_demanded": "claim_amt",
            "disposition_date": "disp_dt",
        },
        "M/d/yyyy", "Cuyahoga County",
    ),
]

# The federal docket feed. Its county is the district, its ids start with FED.
FEDERAL = CourtMapping(
    "FED",
    {
        "case_number": "docket_number", "filing_date": "date_filed", "case_type_raw": "nature_of_suit",
        "disposition_date": "date_terminated", "judge_name": "judge", "cause_of_action": "cause_code",
        "county": "district",
    },
    "yyyy-MM-dd", record_source="FEDERAL_COURT", id_prefix="FED", caption="case_name", status_from_date=True,
)
ALL_COURTS = [*COURTS, FEDERAL]

# Canonical case type of each court's codes.
CASE_TYPE_CODES = {
    "CIVIL": {"TX": ["CV"], "CA": ["CIV"], "NY": ["Civil"], "FL": ["CA"], "IL": ["L"], "OH": ["CV"]},
    "FAMILY": {"TX": ["FM"], "CA": ["FAM"], "NY": ["Matrimonial"], "FL": ["DR"], "IL": ["D"], "OH": ["DR"]},
    "CRIMINAL": {"TX": ["CR"], "CA": ["CRIM"], "NY": ["Criminal"], "FL": ["CF", "MM"], "IL": ["CR"], "OH": ["CR"]},
    "PROBATE": {"TX": ["PR"], "CA": ["PROB"], "NY": ["Surrogate"], "FL": ["CP"], "IL": ["P"], "OH": ["PB"]},
    "SMALL_CLAIMS": {"TX": ["SC"], "CA": ["SC"], "NY": ["Small Claims"], "FL": ["SC"], "IL": ["SC"], "OH": ["SC"]},
    "TAX": {"TX": ["TX"], "CA": ["TAX"], "NY": ["Tax"], "IL": ["TX"], "OH": ["TX"]},
    "EVICTION": {"TX": ["EV"], "CA": ["UD"], "NY": ["L&T"], "FL": ["CC", "EV"], "IL": ["EV"], "OH": ["FED"]},
    "PERSONAL_INJURY": {
        "TX": ["PI"], "CA": ["PI"], "NY": ["Tort"], "FL": ["CA-PI"], "IL": ["L-PI"], "OH": ["CV-PI"],
    },
    "CONTRACT": {"TX": ["CT"], "CA": ["CT"], "NY": ["Contract"], "FL": ["CA-CT"], "IL": ["L-CT"], "OH": ["CV-CT"]},
    "REAL_PROPERTY": {
        "TX": ["RP"], "CA": ["RE"], "NY": ["Real Prop"], "FL": ["CA-RP"], "IL": ["CH"], "OH": ["CV-RP"],
    },
}

# Canonical case type of the federal codes for the nature of a suit; all others are OTHER.
NATURE_OF_SUIT = {
    "CONTRACT": [110, 120, 130, 140, 150, 151, 152, 153, 160, 190, 195, 196],
    "REAL_PROPERTY": [210, 220, 240, 245, 290],
    "EVICTION": [230],
    "PERSONAL_INJURY": [310, 315, 320, 330, 340, 345, 350, 355, 360, 362, 365, 367, 368],
    "CIVIL": [370, 371, 375, 380, 385, 400, 410, 430, 440, 441, 442, 443, 445, 446, 448, 450, 470, 480, 485, 490, 890],
    "TAX": [870, 871],
}

# Canonical status of each court's status words.
STATUS_CODES = {
    "OPEN": {
        "TX": ["PEND"], "CA": ["Active", "Pending"], "NY": ["Active"], "FL": ["OPEN", "REOPEN"],
        "IL": ["Open", "Continued"], "OH": ["ACTIVE"],
    },
    "DISPOSED": {
        "TX": ["DISP", "CLOSED"], "CA": ["Disposed"], "NY": ["Disposed", "Settled", "Judgement Entered"],
        "FL": ["CLOSED", "DISPOSED", "INACTIVE"], "IL": ["Closed", "Disposed"], "OH": ["TERMINATED"],
    },
    "DISMISSED": {"TX": ["DISM"], "CA": ["Dismissed"], "NY": ["Dismissed"], "IL": ["Dismissed"], "OH": ["DISMISSED"]},
    "TRANSFERRED": {"TX": ["TRANSF"], "CA": ["Transferred"], "OH": ["TRANSFERRED"]},
    "APPEALED": {"TX": ["APPEAL"]},
}

# Canonical statuses that no court has a code for; their plain words are accepted from every court.
COMMON_STATUS_WORDS = {"STAYED": ["Stayed", "STAYED"], "SEALED": ["Sealed", "SEALED"]}

CASE_TYPES = [*CASE_TYPE_CODES, "OTHER"]
CASE_STATUSES = ["OPEN", "DISPOSED", "DISMISSED", "TRANSFERRED", "APPEALED", "STAYED", "SEALED", "UNKNOWN"]
STATES = [c.state for c in ALL_COURTS]
