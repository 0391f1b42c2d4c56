"""What differs between loan sources, as plain data.

A new source is a new ``SourceProfile``: its static column list, its history
column list, where the metropolitan code lives, how its servicer is kept and
which history flag means that the borrower is being assisted.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

# The column lists that define the two loan sources.
PLAN_CODE_STATIC = (
    "loan_id", "fp_dt", "channel", "seller", "dti", "term", "ltv", "cltv", "num_borr", "fico", "co_fico",
    "first_time", "purpose", "prop_type", "units", "occ", "state", "msa", "zip3", "mi", "am_type", "ppen", "io",
    "zb_dt", "zb_upb", "fcl_dt", "disp_dt", "fcl_exp", "fcl_p_exp", "fcl_m_exp", "fcl_taxes", "fcl_pro_net",
    "fcl_pro_mi", "fcl_pro_mw", "fcl_pro_oth", "fcl_write_off", "mi_type", "relo", "s_conform", "hltv",
    "reprch_mw", "alt_res", "alt_res_cnt", "tot_defrl", "vintage", "prop_val", "harp", "standard", "ns_doc",
    "ns_uw", "g_guar", "neg_am", "bucket", "rate",
)
PLAN_CODE_MONTHLY = {
    "trg_dt": "month", "trg_upb_act": "upb", "trg_dq": "dq", "trg_rate": "cur_rate", "trg_mod": "mod",
    "trg_zb": "zb", "trg_io_rem": "io_rem", "trg_bap": "bap", "trg_program": "program", "trg_age": "age_fp_dt",
}
PAY_PLAN_STATIC = (
    "fico", "fp_dt", "first_time", "mat_dt", "msa_d", "mi", "units", "occ", "cltv", "dti", "opb", "ltv", "rate",
    "channel", "ppen", "am_type", "state", "prop_type", "zip3", "loan_id", "bucket", "purpose", "term", "num_borr",
    "seller", "servicer", "s_conform", "pre_harp_loan_id", "program", "harp", "val_mthd", "io", "vintage",
    "prop_val", "standard", "lp_dt", "defect_dt", "zb_dt", "zb_upb", "fcl_month", "fcl_pro_net", "fcl_pro_mi",
    "fcl_pro_mw", "fcl_exp", "fcl_l_exp", "fcl_p_exp", "fcl_taxes", "fcl_m_exp", "fcl_loss",
)
PAY_PLAN_MONTHLY = {
    "trg_dt": "month", "trg_upb_act": "upb", "trg_dq": "dq", "trg_reo": "reo", "trg_mod": "mod", "trg_zb": "zb",
    "trg_rate": "cur_rate", "trg_pay_pl": "pay_pl", "trg_age": "age_fp_dt",
}
QA_FIELDS = ("state", "fico", "ltv", "zip3", "prop_val", "num_borr")  # a failure here rejects the loan
QA_ALL_FAIL = ("dq", "cur_rate", "upb")  # every month failed
CARRIED = (  # as-of columns that pass 2 keeps
    "msa_loc", "ao_dt", "ao_age", "ao_dq", "ao_dq_cap6", "ao_upb", "ao_mod", "has_second", "co_borr", "ppen36",
    "servicer", "ao_max_dq12", "ao_months_cur", "ao_times30", "ao_times60", "ao_times90p", "ao_prior30",
    "ao_prior60", "ao_prior90p", "ao_payment", "ao_bap", "ao_rate", "ao_zb", "no_groups",
)


@dataclass(frozen=True)
class SourceProfile:
    """Column map of one loan source."""

    name: str
    static: tuple[str, ...]
    monthly: dict[str, str]
    msa: str
    servicer_history: bool  # servicer is a history column, looked up at the as-of date
    assist_column: str
    assist_values: tuple[str, ...]
    carried: tuple[str, ...]

    def assisted(self) -> Column:
        return (F.col("trg_mod") == "Y") | F.col(self.assist_column).isin(*self.assist_values)

    def narrowed(self, available: list[str]) -> "SourceProfile":
        """The same source with only the static columns a table really has."""
        return replace(self, static=tuple(c for c in self.static if c in available))


PLAN_CODE = SourceProfile(
    name="plan_code",
    static=PLAN_CODE_STATIC,
    monthly=PLAN_CODE_MONTHLY,
    msa="msa",
    servicer_history=True,
    assist_column="trg_bap",
    assist_values=("T", "F", "R"),
    carried=CARRIED,
)
PAY_PLAN = SourceProfile(
    name="pay_plan",
    static=PAY_PLAN_STATIC,
    monthly=PAY_PLAN_MONTHLY,
    msa="msa_d",
    servicer_history=False,
    assist_column="trg_pay_pl",
    assist_values=("Y",),
    carried=tuple(c for c in CARRIED if c not in ("servicer", "ao_bap")),
)
