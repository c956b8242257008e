"""Declared schemas of job inputs and outputs.

Fixed values: table and column names must equal those of the data, in declared order.
"""

from __future__ import annotations

from pyspark.sql import types as T

from portfolio_ops.functions import fixed_values as fv

MONEY = T.DecimalType(19, 4)
LINE = T.DecimalType(20, 4)
RATE = T.DecimalType(19, 12)
ID38 = T.DecimalType(38, 0)
TEXT = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
TIME = T.TimestampType()
LOCAL_TIME = T.TimestampNTZType()
FLAG = T.BooleanType()


def struct(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


def texts(names: str) -> list[tuple[str, T.DataType]]:
    return [(n, TEXT) for n in names.split()]


# -- claim movements --------------------------------------------------------
PARTS = ["indemnity", "fees", "defence"]

MOVEMENT_KEYS = texts("source_system claim_exposure_source_id movement_reference_source_id") + [
    ("sequence_number", LONG), ("settlement_currency", TEXT), ("original_currency", TEXT)]

MOVEMENT = struct(
    *MOVEMENT_KEYS,
    ("movement_type", TEXT), ("movement_period", TIME), ("movement_date", TIME),
    ("original_ccy_to_group_ccy_rate", RATE),
    ("outstanding_original_ccy_to_settlement_ccy_rate", RATE),
    ("paid_original_ccy_to_settlement_ccy_rate", RATE),
    *[(f"movement_reserve_{p}_amount_in_original_ccy", MONEY) for p in PARTS],
    *[(f"movement_paid_{p}_in_original_ccy", MONEY) for p in PARTS],
    *[(f"to_date_paid_{p}_in_reserving_ccy", MONEY) for p in PARTS],
    *[(f"to_date_outstanding_{p}_in_reserving_ccy", MONEY) for p in PARTS],
    *[(f"{k}_amount_in_{ccy}_ccy", LINE) for k in ("net_payment", "tax")
      for ccy in ("original", "settlement")],
    ("does_not_erode_reserves", FLAG), ("source_system_event_date_time", TIME), ("is_active", INT))

MOVEMENT_EXT = struct(
    *MOVEMENT_KEYS, ("transaction_created_on", TIME), ("payment_id", TEXT), ("payment_type", TEXT),
    ("signed_line", LINE), ("transaction_tracking_status", TEXT), ("transfer_status", TEXT),
    ("is_active", INT))
EXPOSURE = struct(*texts("claim_exposure_source_id source_system claim_source_id"),
                  ("exposure_opened_date", TIME), ("signed", LINE), ("is_active", INT))
EXPOSURE_EXT = struct(*texts("claim_exposure_source_id source_system scm_reference"),
                      ("is_active", INT))
CLAIM = struct(*texts("claim_source_id source_system"), ("is_active", INT),
               ("incident_report", INT), ("is_retired", INT))
EXCHANGE_RATE = struct(("id", LONG), ("currency_code_name", TEXT), ("rate_type_id", INT),
                       ("rate_to_usd", RATE), ("effective_from_date", TIME))
LATEST_RUN = struct(("id", TEXT))

LEDGER_KEYS = ["exposure_reference", "sequence_number", "movement_reference",
               "settlement_currency", "original_currency"]


def amounts(stem: str) -> list[str]:
    """The nine amount columns of a measure: per part in the original currency, then
    per part converted and unconverted settlement."""
    return ([f"{stem}_{p}_in_original_ccy" for p in PARTS]
            + [f"{stem}_{p}_in_{ccy}_ccy" for p in PARTS
               for ccy in ("settlement", "source_settlement")])


TO_DATE, PAID, OUTSTANDING = "to_date_outstanding", "movement_paid", "movement_outstanding"
SIDE_AMOUNTS = [f"movement_{k}_amount_in_{ccy}_ccy" for k in ("net_payment", "tax")
                for ccy in ("original", "settlement")]

LEDGER = struct(
    ("exposure_reference", TEXT), ("sequence_number", LONG), ("movement_reference", TEXT),
    ("settlement_currency", TEXT), ("settlement_source_currency", TEXT), ("original_currency", TEXT),
    ("movement_group_id", LONG, False), ("movement_group_sequence_id", LONG, False),
    ("sequence_number_order_id", LONG, False),
    ("outstanding_original_ccy_to_settlement_ccy_rate", RATE, False),
    ("paid_original_ccy_to_settlement_ccy_rate", RATE, False),
    ("movement_date", TIME),
    *[(n, MONEY, False) for n in amounts(TO_DATE)],
    *[(n, MONEY, False) for n in amounts(PAID)],
    ("movement_type", TEXT),
    *[(n, MONEY, False) for n in amounts(OUTSTANDING)],
    ("does_not_erode_reserves", FLAG),
    *[(f"{p}_reserve_in_settlement_ccy", MONEY) for p in PARTS],
    ("payment_id", TEXT), ("payment_type", TEXT), ("signed_line", LINE),
    ("transaction_tracking_status", TEXT), ("transfer_status", TEXT),
    *[(n, LINE) for n in SIDE_AMOUNTS],
    ("movement_creation_date", TIME))
LEDGER_AUDIT = struct(("row_hash_key", T.BinaryType()), ("created_at_ts", TIME),
                      *texts("created_by created_from process_id source_name"))
LEDGER_TABLE = T.StructType(LEDGER.fields + LEDGER_AUDIT.fields)

# -- policy load ------------------------------------------------------------
_AUDIT = [("AuditCreateDateTime", LOCAL_TIME), ("AuditModifyDateTime", LOCAL_TIME)]
_INTS = {"IsRenewal", "IsQuote", "IsBoundQuote", "YearOfAccount", "UPIFlag", "PriorityDelete"}
_TIMES = {"ErpExpirationDate", "EarliestRationaleQuestionnaireDate"}
_RATES = {"TriaPercentage", "LimitCCYToSettlementCCYRateCurrent", "LimitCCYToSettlementCCYRateMelded"}


def policy_type(name: str) -> T.DataType:
    return (INT if name in _INTS else LOCAL_TIME if name in _TIMES
            else RATE if name in _RATES else TEXT)


POLICY_ALL = struct(*[(n, policy_type(n)) for n in fv.POLICY_COLUMNS])
POLICY = struct(("PolicySourceId", TEXT), ("IsAdmitted", TEXT), ("MarketSegment", TEXT),
                ("IsRenewal", INT), *[(n, policy_type(n)) for n in fv.POLICY_OWN_COLUMNS], *_AUDIT)
_COMPUTED = {"IsAdmitted", "MarketSegment", "IsRenewal", "PriorityDelete"}
POLICY_EXT = struct(
    ("SourceSystem", TEXT), ("PolicySourceId", TEXT),
    *[(n, policy_type(n)) for n in fv.POLICY_COLUMNS
      if n not in {*fv.POLICY_OWN_COLUMNS, *fv.POLICY_SECTION_COLUMNS, *_COMPUTED}], *_AUDIT)
SECTION_EXT = struct(("SourceSystem", TEXT), ("PolicySourceId", TEXT), ("SectionSequenceId", INT),
                     ("ErpExpirationDate", LOCAL_TIME),
                     *[(n, policy_type(n)) for n in fv.POLICY_SECTION_COLUMNS], *_AUDIT)
PLACEMENT_METHOD = struct(("Code", TEXT), ("Name", TEXT))
STORED_POLICY = struct(("PolicyReference", TEXT), ("SourceSystem", TEXT), *_AUDIT)
DEDUPE_LIST = struct(*texts("PolicyReference SectionReference LondonRefNo"))

# -- homeowners feed --------------------------------------------------------
FEED = struct(
    *texts("PK_Policy FK_Policy PK_Section PolicyReference SectionReference"),
    ("SectionSequenceID", INT), ("IsQuote", INT),
    *texts("""ExpiringPolicyReference IsAdmitted PlacingBrokerContact PlacingBrokerState
    PlacingBrokerBranchName InsuredName InsuredCity InsuredState UniqueMarketReference
    BrokerBeazleyTradeId YearOfAccount InceptionDate ExpiryDate CoverageName TriFocus
    SectionStatus ProductName UnderwriterName PolLimitCurrency OriginalCurrency
    SettlementCurrency PolicyLimit PolicyDeductible FacilityReference ClassOfBusinessCode
    BindDate Peril LloydsRiskCode OfficeLocation LeadInsurerPseudo TermsOfTradeDate IsSigned
    WrittenLine WrittenOrder SignedLine SignedOrder EstimatedSigning WrittenOrEstimatedPremium
    EventLimit LimitQualifier ExcessAmount ExcessQualifier DeductiblePercentage
    ExternalAcquisitionCostPercentage InternalAcquisitionCostPercentage
    InternalAcquisitionCostAmount RateChangePercentage BenchmarkPremiumPercentage
    BenchmarkPremiumAmount OriginalToSettlementCurrencyRate LimitToSettlementCurrencyRate
    InsuredItemNarrative OccupancyDescription"""))
SECTION_SOURCE = struct(("FK_YOA", INT), ("SectionReference", TEXT), ("SectionReferenceCOBCode", TEXT))

# -- cession ----------------------------------------------------------------
_CEDED = ["CededPremiumToInternalQuotaShareTreaty"]
PREMIUM = struct(("Reference", TEXT), ("Period2", INT),
                 *[(n, MONEY) for n in ("GPW", "ICWP_F", "ICWP_Q", "ICWP_S", "ICWP_EMBQ")])
MARINE_PREMIUM = struct(("Reference", TEXT), ("Period2", INT), ("GrossWrittenPremium", MONEY),
                        *[(n, MONEY) for n in _CEDED + ["CededPremiumToInternalFAC"]])
WEATHER_PREMIUM = struct(("Reference", TEXT), ("Period2", INT), ("GrossWrittenPremium", MONEY),
                         *[(n, MONEY) for n in _CEDED + ["CededPremiumToInternalSurplusTreaty"]])

# -- claims and binders -----------------------------------------------------
CLAIM_EXPOSURE = struct(*texts("SourceSystem ClaimSourceId BinderReference"))
CLAIM_HEADER = struct(*texts("SourceSystem ClaimSourceId PolicyNumber"), ("IsRetired", INT))

# -- rating facts -----------------------------------------------------------
_RATING_META = [("EVENT_LOAD_TIMESTAMP", TIME), ("RECORD_KAFKA_NPTS", TIME),
                ("RECORD_KAFKA_OFFSET", LONG), ("RECORD_KAFKA_PARTITION", INT)]
_RATING_AUDIT = texts("CREATED_BY CREATED_FROM PROCESS_ID SOURCE_NAME")
RATING_INTERIM = struct(*texts(" ".join(fv.KEY_INDUSTRY_KEYS)), ("RECORD_CONTENT", TEXT),
                        *_RATING_META, *_RATING_AUDIT)
KEY_INDUSTRY = struct(
    *texts("BK_RATER_NAME BK_VERSION BK_RATING_ID KEY_INDUSTRY_KEY BK_CLIENT_SUPPLIED_ID"
           " CODE_NAME CODE_TYPE"),
    *_RATING_META, ("CREATED_AT", LOCAL_TIME), *_RATING_AUDIT)

# -- section-mapping override -----------------------------------------------
MAPPING_OVERRIDE = struct(
    ("ID", ID38), ("MUID", TEXT), ("VERSION_NAME", TEXT), ("VERSION_NUMBER", ID38),
    ("VERSION_ID", ID38), ("VERSION_FLAG", TEXT), ("NAME", TEXT), ("CODE", TEXT),
    ("CHANGE_TRACKING_MASK", ID38),
    *texts("CCV9_EXPOSURE_REFERENCE NEW_SECTION_REFERENCE START_DATE_INCLUSIVE"
           " END_DATE_INCLUSIVE SOURCE_SYSTEM_NAME COMMENT"),
    ("ENTER_DATE_TIME", TIME), ("ENTER_USER_NAME", TEXT), ("ENTER_VERSION_NUMBER", ID38),
    ("LAST_CHG_DATE_TIME", TIME), ("LAST_CHG_USER_NAME", TEXT), ("LAST_CHG_VERSION_NUMBER", ID38),
    ("VALIDATION_STATUS", TEXT), ("CREATED_AT", TIME),
    *texts("CREATED_BY CREATED_FROM PROCESS_ID SOURCE_NAME"), ("IS_DELETED", FLAG))
