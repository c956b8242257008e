"""Focus code and focus name of a policy line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.functions.exprs import left_part


def trifocus_code(details: DataFrame, policy: DataFrame, risk_class: DataFrame,
                  focus_area: DataFrame, class_of_business: DataFrame,
                  dept: str = fv.SPECIALTY_DEPT) -> DataFrame:
    """Department, section and policy reference, and the focus name.

    Lines of ``dept`` take the focus area found by five codes, else their own focus;
    lines of other departments take the group of their class. A missing department is
    in neither branch. Both branches read the sources once: the branch is a condition,
    not a second scan. A line of ``dept`` needs a first risk class.
    """
    first_class = (risk_class.filter(F.col("prc_sequence_no") == 1)
                   .select("prc_cpd_policy_ref", "prc_risk_class"))
    rows = (details.join(policy, F.col("cpd_policy_reference") == F.col("pol_cpd_policy_reference"))
            .join(class_of_business, F.col("pol_cob_code") == F.col("cob_code"))
            .filter(F.col("cob_dept").isNotNull()))
    special = F.col("cob_dept") == dept
    rows = rows.join(first_class, special & (F.col("cpd_policy_reference") == F.col("prc_cpd_policy_ref")),
                     "left").filter(~special | F.col("prc_cpd_policy_ref").isNotNull())
    rows = rows.join(
        focus_area,
        special & (F.col("foc_cob_code") == F.col("pol_cob_code"))
        & (F.col("foc_risk_class") == F.col("prc_risk_class"))
        & (F.col("foc_mop_code") == F.col("pol_mop_code"))
        & (F.col("foc_udt_initials") == F.col("cpd_udt_initials"))
        & (F.col("foc_stats_code") == F.col("pol_stats_code")), "left")
    name = (F.when(special, F.coalesce("foc_area", "cpd_tri_focus"))
            .otherwise(F.col("cob_tri_group")))
    return rows.select(
        "cob_dept", F.col("cpd_policy_reference").alias("section_reference"),
        left_part("cpd_policy_reference", fv.POLICY_REFERENCE_LENGTH).alias("policy_reference"),
        name.alias("TrifocusName"))


def trifocus_name(product: Column, company: Column, target: Column, own: Column) -> Column:
    rule = F.when(product.isin(fv.MARINE_PRODUCTS), F.lit(fv.MARINE_FOCUS))
    for pattern, name in fv.BUILDERS_RISK_FOCUS.items():
        rule = rule.when(product.like(fv.BUILDERS_RISK_PRODUCT) & company.like(pattern), F.lit(name))
    return rule.otherwise(F.coalesce(target, own))
