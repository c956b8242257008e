import datetime as dt

import pytest

from portfolio_ops import schemas as s
from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.plans.policy_delta import PolicyInputs, changed_policies, policy_delta

OLD, MARK, NEW = (dt.datetime(y, 1, 1) for y in (2019, 2020, 2021))
PRO, CONTRACT, UNI = fv.PRO_SOURCE, fv.DATA_CONTRACT_SOURCE, fv.UNIRISX_SOURCE

# reference, source, created, ext values
POLICIES = [
    ("new", PRO, NEW, dict(UPIFlag=None, TriaPercentage=None)),
    ("equal", "GAMECHANGER", MARK, {}),
    ("unchanged", "Eurobase", OLD, {}),
    ("unknown", "Eurobase", OLD, {}),
    ("listed", "Eurobase", OLD, {}),
    ("section", "Eurobase", OLD, {}),
    ("excluded", "Eurobase", NEW, dict(OriginatingSourceSystem="fdr ")),
    ("ezold", "Eurobase", NEW, dict(OriginatingSourceSystem=fv.RETIRED_ORIGIN)),
    ("eznew", "Eurobase", NEW, dict(OriginatingSourceSystem=fv.RETIRED_ORIGIN)),
    ("pair1", fv.FDR_SOURCE, NEW, {}), ("pair1", PRO, NEW, {}),
    ("pair2", CONTRACT, NEW, {}),
    ("dc1", CONTRACT, NEW, {}), ("dc2", CONTRACT, NEW, {}),
]
STORED = [("unchanged", "x", OLD, None), ("equal", "x", OLD, MARK), ("section", "x", OLD, None), ("pair2", UNI, OLD, None)]


@pytest.fixture(scope="module")
def inputs(make):
    policy, ext = [], []
    for i, (ref, source, created, more) in enumerate(POLICIES):
        policy.append(dict(SourceSystem=source, PolicySourceId=str(i), PolicyReference=ref, HashBytesId=f"h{i}",
                           IsAdmitted="1" if ref == "dc1" else "0", MarketSegment={"dc1": "PE", "dc2": "XX"}.get(ref, "MM"),
                           YearOfAccount=2016 if ref == "ezold" else 2017, IsRenewal=5, AuditCreateDateTime=created,
                           ExpiringPolicyReference="prior" if ref == "new" else None))
        ext.append(dict(SourceSystem=source.lower(), PolicySourceId=str(i), AuditCreateDateTime=OLD, MethodOfPlacement="own",
                        MethodOfPlacementCode="V", ErpExpirationDate=OLD, **more))
    section = [dict(SourceSystem=POLICIES[i][1], PolicySourceId=str(i), SectionSequenceId=n, ErpExpirationDate=NEW,
                    AuditCreateDateTime=NEW if POLICIES[i][0] == "section" else OLD)
               for i in range(len(POLICIES)) for n in (1, 2) if POLICIES[i][0] in ("section", "equal")]
    return PolicyInputs(make(s.POLICY, policy), make(s.POLICY_EXT, ext), make(s.SECTION_EXT, section),
                        make(s.PLACEMENT_METHOD, [dict(Code="v", Name="method")]),
                        make(s.DEDUPE_LIST, [dict(PolicyReference="LISTED"), dict(PolicyReference="listed")]))


@pytest.fixture(scope="module")
def delta(make, inputs):
    stored = make(s.STORED_POLICY, [dict(zip(s.STORED_POLICY.fieldNames(), r)) for r in STORED])
    return {(r["PolicyReference"], r["SourceSystem"]): r for r in policy_delta(inputs, stored).collect()}


def test_rows_kept(delta):
    assert set(delta) == {("new", PRO), ("equal", "GAMECHANGER"), ("unknown", "Eurobase"), ("section", "Eurobase"),
                          ("ezold", "Eurobase"), ("pair1", PRO), ("dc1", CONTRACT), ("dc2", CONTRACT)}


def test_source_rules(delta):
    new, game, dc1, dc2 = (delta[k] for k in (("new", PRO), ("equal", "GAMECHANGER"), ("dc1", CONTRACT), ("dc2", CONTRACT)))
    assert (new["IsRenewal"], new["UPIFlag"], new["PriorityDelete"], new["MethodOfPlacement"]) == (1, 0, 1, "method")
    assert (game["ErpExpirationDate"], game["IsRenewal"], game["TriaPercentage"]) == (NEW, 5, None)
    assert (dc1["IsAdmitted"], dc1["MarketSegment"], dc1["MethodOfPlacementCode"], dc1["MethodOfPlacement"]) == (
        fv.ADMITTED_LABEL, "Private Enterprise", "V", "method")
    # unknown segment and unlisted method code give NULL for this source
    assert (dc2["MarketSegment"], dc2["MethodOfPlacementCode"], dc2["MethodOfPlacement"], dc2["IsRenewal"]) == (None, "W", None, None)
    assert delta[("pair1", PRO)]["IsRenewal"] is None


def test_first_load_keeps_one_source_per_reference(make, inputs):
    rows = policy_delta(inputs, make(s.STORED_POLICY, [])).collect()
    refs = [r["PolicyReference"] for r in rows]
    assert len(refs) == len(set(refs)) and {"unchanged", "listed", "pair2"} <= set(refs)
    assert {r["SourceSystem"] for r in rows if r["PolicyReference"] == "pair1"} == {PRO}


def test_output_columns(inputs):
    assert len(fv.POLICY_COLUMNS) == len(set(fv.POLICY_COLUMNS)) == 81


def test_wide_rows_are_read_after_the_candidate_keys(make, inputs, tmp_path, spark):
    """Each wide side meets the candidate keys in a semi join below the join of the sides, and the
    candidate scan has keys, times and references only."""
    stored = make(s.STORED_POLICY, [dict(zip(s.STORED_POLICY.fieldNames(), r)) for r in STORED])
    saved = {}
    for name in ("policy", "policy_ext", "section_ext", "placement_method", "dedupe"):
        getattr(inputs, name).write.parquet(str(tmp_path / name))
        saved[name] = spark.read.parquet(str(tmp_path / name))
    plans = []
    import portfolio_ops.plans.policy_delta as module
    real = module.stage

    def looking(df, label="stage"):
        plans.append((label, df._jdf.queryExecution().explainString(
            df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))))
        return real(df, label)
    module.stage = looking
    try:
        rows = changed_policies(PolicyInputs(**saved), stored, MARK)
    finally:
        module.stage = real
    (label, narrow), = plans
    assert label == "candidates" and "CRMBrokerName" not in narrow and "MarketSegment" not in narrow
    assert narrow.count("Or(GreaterThanOrEqual(AuditModifyDateTime") == 3
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 3
    below = plan[plan.index("Join Inner"):]
    assert below.count("Join LeftSemi") == 3        # all of them below the join of the sides
    assert rows.count() > 0


def test_rows_that_only_meet_in_part_are_not_taken(make, inputs):
    """A key with two extension rows, one changed: only the changed one comes."""
    policy = make(s.POLICY, [dict(SourceSystem="X", PolicySourceId="1", PolicyReference="r", HashBytesId="h",
                                  AuditCreateDateTime=OLD)])
    ext = make(s.POLICY_EXT, [dict(SourceSystem="x", PolicySourceId="1", AuditCreateDateTime=t, CRMBrokerName=n)
                              for t, n in ((OLD, "old"), (NEW, "new"))])
    stored = make(s.STORED_POLICY, [dict(PolicyReference="R", SourceSystem="x", AuditCreateDateTime=MARK)])
    own = PolicyInputs(policy, ext, make(s.SECTION_EXT, []), inputs.placement_method, make(s.DEDUPE_LIST, []))
    assert [r["CRMBrokerName"] for r in policy_delta(own, stored).collect()] == ["new"]
