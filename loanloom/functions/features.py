"""Row-local features: ratios, crosses, flags and per-row statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

EPS = 1e-6
# Occupation risk classes, 1 low to 5 very high; others count as 3.
OCCUPATION_RISK = {"公务员": 1, "教师": 1, "医生": 1, "工程师": 2, "销售": 3, "个体工商户": 3, "自由职业": 4, "无业": 5}
OCCUPATION_DEFAULT = 3


def guarded_ratio(top: Column, bottom: Column, eps: float = EPS) -> Column:
    return F.try_divide(top, bottom + F.lit(eps))


def loan_ratios(df: DataFrame) -> dict[str, Column]:
    """Ratio features whose inputs are present, by name."""
    c = F.col
    rules = {
        "loanToIncome": (("loanAmnt", "annualIncome"), lambda: guarded_ratio(c("loanAmnt"), c("annualIncome"))),
        "installmentToIncome": (
            ("installment", "annualIncome"), lambda: guarded_ratio(c("installment"), c("annualIncome") / 12)),
        "ficoMean": (("ficoRangeLow", "ficoRangeHigh"), lambda: (c("ficoRangeLow") + c("ficoRangeHigh")) / 2),
        "ficoRange": (("ficoRangeLow", "ficoRangeHigh"), lambda: c("ficoRangeHigh") - c("ficoRangeLow")),
        "revolUtil_norm": (("revolUtil",), lambda: c("revolUtil") / 100),
        "openAccRatio": (("openAcc", "totalAcc"), lambda: guarded_ratio(c("openAcc"), c("totalAcc"))),
        "dti_x_rate": (("dti", "interestRate"), lambda: c("dti") * c("interestRate")),
    }
    have = set(df.columns)
    return {name: make() for name, (needs, make) in rules.items() if have.issuperset(needs)}


def with_loan_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(loan_ratios(df))


def debt_ratios(df: DataFrame) -> dict[str, Column]:
    pairs = {
        "debt_to_income": ("total_debt", "monthly_income"),
        "credit_utilization": ("used_credit", "total_credit_limit"),
        "payment_coverage": ("monthly_payment", "monthly_income"),
        "recent_overdue_ratio": ("overdue_m3", "overdue_m12"),
    }
    have = set(df.columns)
    return {n: guarded_ratio(F.col(a), F.col(b)) for n, (a, b) in pairs.items() if have.issuperset((a, b))}


def product(a: str, b: str) -> Column:
    return F.col(a) * F.col(b)


def shifted_ratio(a: str, b: str, shift: float = 1) -> Column:
    return F.try_divide(F.col(a), F.col(b) + F.lit(shift))


def anonymous_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c.startswith("n") and c[1:].isdigit()]


def with_row_statistics(df: DataFrame, columns: Sequence[str], prefix: str = "n") -> DataFrame:
    """Mean, sample deviation, min, max, NULL count and bias-corrected skew across columns of a row.

    Count, mean and moments are computed in steps that the planner keeps apart, so that no step repeats
    the one before it inside every cell.
    """
    cells = [F.col(c).cast("double") for c in columns]
    add = lambda parts: sum(parts[1:], parts[0])
    n, mean, m2, m3 = (F.col(f"_{prefix}_{x}") for x in ("n", "m", "m2", "m3"))
    df = df.withColumn(f"_{prefix}_n", add([F.when(c.isNotNull(), 1.0).otherwise(0.0) for c in cells]))
    df = df.withColumn(f"_{prefix}_m", F.try_divide(add([F.coalesce(c, F.lit(0.0)) for c in cells]), n))
    off = [F.coalesce(c - mean, F.lit(0.0)) for c in cells]
    df = df.withColumns({f"_{prefix}_m2": add([d * d for d in off]), f"_{prefix}_m3": add([d * d * d for d in off])})
    var_n = F.try_divide(m2, n)
    g1 = m3 / n / (var_n * F.sqrt(var_n)) * F.sqrt(n * (n - 1)) / (n - 2)
    return df.withColumns({
        f"{prefix}_mean": mean,
        f"{prefix}_std": F.when(n > 1, F.sqrt(m2 / (n - 1))),
        f"{prefix}_min": F.least(*cells),
        f"{prefix}_max": F.greatest(*cells),
        f"{prefix}_null_cnt": (F.lit(len(cells)) - n).cast("int"),
        f"{prefix}_skew": F.when(n < 3, None).when(var_n < 1e-14, 0.0).otherwise(g1),
    }).drop(*[f"_{prefix}_{x}" for x in ("n", "m", "m2", "m3")])


def lookup(key: Column, table: Mapping, default) -> Column:
    """Small dictionary with a default as a literal map."""
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(known, key), F.lit(default))


def occupation_risk(c: Column) -> Column:
    return lookup(c, OCCUPATION_RISK, OCCUPATION_DEFAULT)


def missing_flag(c: Column) -> Column:
    return c.isNotNull().cast("int")


def behaviour_features(log: DataFrame) -> DataFrame:
    """Form-filling behaviour: duration, edit and paste counts, haste flags.

    Event list columns are counted by their length, numeric columns are taken as counts.
    """
    kinds = dict(log.dtypes)
    count = lambda c: F.coalesce(F.size(c), F.lit(0)) if kinds[c].startswith("array") else F.col(c)
    counts = {
        "phone_modify_count": "phone_changes", "id_modify_count": "id_changes", "page_back_count": "back_events",
        "paste_phone_count": "phone_pastes", "paste_id_count": "id_pastes", "paste_bank_count": "bank_pastes",
    }
    seconds = F.unix_timestamp(F.col("submit_time").cast("timestamp")) - F.unix_timestamp(
        F.col("start_time").cast("timestamp")
    )
    out = log.withColumns({n: count(c) for n, c in counts.items() if c in kinds})
    out = out.withColumns({"fill_seconds": seconds, "is_suspiciously_fast": seconds < 30})
    pastes = [n for n in ("paste_phone_count", "paste_id_count", "paste_bank_count") if n in out.columns]
    if pastes:
        out = out.withColumn("total_paste_count", sum((F.col(p) for p in pastes), F.lit(0)))
    if "privacy_stay_time" in kinds:
        stay = F.coalesce(F.col("privacy_stay_time"), F.lit(0))
        out = out.withColumns({"privacy_stay_seconds": stay, "skim_privacy_policy": stay < 2})
    return out


def risk_level(p: Column) -> Column:
    return F.when(p > 0.15, "HIGH").when(p > 0.05, "MEDIUM").otherwise("LOW")


def score_scale(base_score: float = 600, base_odds: float = 1 / 50, pdo: float = 20) -> tuple[float, float]:
    """(A, B) of score = A - B * ln(bad odds). ``base_odds`` is bad to good; pass 50 for the inverse reading."""
    import math

    b = pdo / math.log(2)
    return base_score + b * math.log(base_odds), b


def log_odds_score(log_odds: Column, base_score: float = 600, base_odds: float = 1 / 50, pdo: float = 20) -> Column:
    a, b = score_scale(base_score, base_odds, pdo)
    return F.lit(a) - F.lit(b) * log_odds


def probability_score(p: Column, base_score: float = 600, base_odds: float = 1 / 50, pdo: float = 20) -> Column:
    """Whole-number score of a probability, rounded half to even."""
    odds = F.log(p / (1 - p + F.lit(1e-9)))
    return F.rint(log_odds_score(odds, base_score, base_odds, pdo)).cast("int")


def expected_loss(pd: Column, lgd: Column, ead: Column) -> Column:
    return pd * lgd * ead


def business_anomalies(df: DataFrame, income: str, amount: str, age: str | None = None, multiple: float = 10):
    """Quality flags that stay as columns: zero income, age out of range, amount far above income."""
    flags = {
        "zero_income": F.coalesce(F.col(income) == 0, F.lit(False)),
        "amount_above_income": F.coalesce(F.col(amount) > multiple * F.col(income), F.lit(False)),
    }
    if age:
        flags["age_out_of_range"] = F.coalesce((F.col(age) < 18) | (F.col(age) > 70), F.lit(False))
    return df.withColumns({k: v.cast("int") for k, v in flags.items()})
