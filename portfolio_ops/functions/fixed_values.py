"""Fixed values.

Every literal in this file is data: it must equal what the source systems write,
otherwise rows would be classified differently. Nothing here is logic.
"""

# -- claim movements --------------------------------------------------------
CLAIM_SOURCE = "ClaimCenter"
KEPT_CURRENCIES = ["EUR", "USD", "CAD", "GBP"]
REPORTING_CURRENCY = "USD"
RATE_TYPE_ID = 3
MIGRATED_TYPE = "SCM"
RECOVERY_TYPE = "Recovery"
PAYMENT_TYPE = "Payment"
COMPLETED_STATUSES = ["Migration", "Transaction Complete"]
# order of the three currency-switch references inside one date
SWITCH_ORDER = {"YA%": 1, "YC%": 2, "YB%": 3}
DUMMY_REFERENCE = "DUMMY MOVEMENT"
DUMMY_TYPE = "N/A"
MISSING_MOVEMENT_DATE = "1753-01-01"
LEDGER_CREATED_FROM = "STG"
LEDGER_SOURCE_NAME = "BI Data Contract"
HASH_SEPARATOR = "#"
HASH_NULL = "NULL"
HASH_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSxxx"

# -- policy load ------------------------------------------------------------
FIRST_LOAD_MARK = "1900-01-01"
DATA_CONTRACT_SOURCE = "StagingDataContract"
PRO_SOURCE = "BeazleyPro"
ERP_FROM_SECTION_SOURCE = "GameChanger"
FDR_SOURCE = "FDR"
UNIRISX_SOURCE = "Unirisx"
PRIORITY_ONE_SOURCES = ["Eurobase", "Unirisx", "Gamechanger", "CIPS", "myBeazley",
                        "US High Value Homeowners", "USHVH", "BeazleyPro"]
PRIORITY_TWO_SOURCE = "FDR"
MISSING_ORIGIN = "N\\A"
EXCLUDED_ORIGINS = ["FDR", "USHVH", "US High Value Homeowners"]
RETIRED_ORIGIN = "EazyPro"
RETIRED_ORIGIN_FROM_YEAR = 2017
ADMITTED_FLAG = "1"
ADMITTED_LABEL = "Lloyds"
ADMITTED_METHOD_CODE = "V"
OTHER_METHOD_CODE = "W"
MARKET_SEGMENTS = {"PE": "Private Enterprise", "MM": "Mid-Market"}
# (superseded source, superseding source) for one policy reference
SUPERSEDED_SOURCES = [("FDR", "BeazleyPro"), ("StagingDataContract", "Unirisx")]

# output columns of the policy load, in table order
POLICY_COLUMNS = """
PolicyReference SourceSystem SourceSystemRiskId AdditionalInsuredParty InsuredAddress
InsuredCity InsuredState InsuredCountry InsuredPostCode IsAdmitted AffinityIdentifier
AgressoBrokerID AnnualRevenues AttachmentPoint BrokerAccessPolicyNumber BrokerNetworkName
CapitaBrokerID Cedant Coinsurance ContractBasis CoverholderName
EarliestRationaleQuestionnaireDate ErpExpirationDate FundType InitiativeUS InsuranceType
InsuredName InsuredLegalTradingName BrokerAccessReferralFlag IsNewYorkFreeTradeZone IsQuote
IsBoundQuote ExpiringPolicyReference EndorsementNumber MarketSegment MarketSegmentCode
McareAssessment MethodOfPlacement MethodOfPlacementCode NetworkEndDate NetworkStartDate
BrokerNoticeOfClaim PatientCompensationFund PlacingBrokerContact PlacingBrokerNumber
PlacingBrokerSourceId PolicyReferenceMOPCode PolicyReferenceMOPCodeRiskNumber
PolicyReferenceRiskNumber PolicyReferenceYOA PolicyType PolicyURL PolicyURLLabel
ProducingBrokerContact ReinsuredParty RiskType RunOffDate ServiceCompanyLocation
BrokerServiceOfSuit UPIFlag UniqueMarketReference YearOfAccount HashBytesId
ProducingBrokerBranchName ProducingBrokerSourceId PlacingBrokerBranchName CRMBrokerName
DomicileCountry IsRenewal ProducingBrokerNumber BrokerBeazleyTradeId
LimitCCYToSettlementCCYRateCurrent LimitCCYToSettlementCCYRateMelded PriorityDelete
SourcesystemKey TaxPercentage TriaPercentage OriginatingSourceSystem
USMiscMedLifeSciencesPolicyCOBCode LargeRiskExemption LeadFeesPercentage
""".split()
# of those, the ones stored on the policy and on the first section
POLICY_OWN_COLUMNS = """
PolicyReference SourceSystem InsuredCity InsuredState InsuredCountry InsuredName
InsuredLegalTradingName IsQuote IsBoundQuote ExpiringPolicyReference MarketSegmentCode
PlacingBrokerContact PlacingBrokerNumber PlacingBrokerSourceId UniqueMarketReference
YearOfAccount HashBytesId PlacingBrokerBranchName
""".split()
POLICY_SECTION_COLUMNS = """
EarliestRationaleQuestionnaireDate LimitCCYToSettlementCCYRateCurrent
LimitCCYToSettlementCCYRateMelded
""".split()

# -- homeowners feed --------------------------------------------------------
BINDER_PREFIX = "B6188C%"
BINDER_CLASS_CODES = ["YH", "3Y"]
BINDER_SUFFIXES = ["_YH", "_3Y"]
FLOOD_PRODUCT = "Excess Flood"
WIND_PRODUCT = "Excess Wind & Hail"
WIND_SWITCH_YEAR = 2018
EXCLUDED_TRIFOCUS = "BESI Homeowners"
FIRST_UNDERWRITING_YEAR = 2010
HOMEOWNERS_COUNTRY = "USA"
HOMEOWNERS_SEGMENT = "MM"
DEFAULT_LIMIT_CURRENCY = "USD"
DEDUCTIBLE_QUALIFIER = "AOP"
TRANSACTION_CLASS = "AAP"
SECTION_STATUS = {
    "RENEWAL QUOTE": "Quote",
    "BOUND REINSTATE": "Live",
    "BOUND": "Live",
    "BOUND RENEWAL": "Live",
    "BOUND MTA": "Live",
    "CANCELLED": "Cancelled",
    "MTA QUOTE": "Live",
    "QUOTED": "Quote",
    "DOC VERSION FOR OUTLINE MTA": "Live",
    "ERROR CORRECTION": "Cancelled",
}
# postal codes of the fifty US states
STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas",
    "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho",
    "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas",
    "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma",
    "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah",
    "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia",
    "WI": "Wisconsin", "WY": "Wyoming",
}

# -- claim / binder pairs ---------------------------------------------------
CLAIM_BINDER_SOURCE = "claimcenter"

# -- rating facts -----------------------------------------------------------
KEY_INDUSTRY_PATHS = {
    "KEY_INDUSTRY_KEY": "$.Result.Key_Industry.Code_Str",
    "CODE_NAME": "$.Result.Key_Industry.Code_Name",
    "CODE_TYPE": "$.Result.Key_Industry.Code_Type",
}
KEY_INDUSTRY_KEYS = ["BK_RATER_NAME", "BK_VERSION", "BK_RATING_ID", "BK_CLIENT_SUPPLIED_ID"]

# -- focus rules ------------------------------------------------------------
SPECIALTY_DEPT = "Specialty Lines"
POLICY_REFERENCE_LENGTH = 8
MARINE_PRODUCTS = ["UK CARGO/FREIGHT", "UK CARGO/FREIGHT 2012", "UK CARGO/FREIGHT v3",
                   "UK HULL", "UK HULL 2012", "UK HULL v5"]
MARINE_FOCUS = "UK Marine"
BUILDERS_RISK_PRODUCT = "US Builders Risk%"
# issuing-company pattern -> focus name, first match wins
BUILDERS_RISK_FOCUS = {
    "%Beazley%Lloyd%": "BUSA Engineering",
    "%Beazley%Company%Inc%": "BICI Engineering",
}
