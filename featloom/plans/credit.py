"""The three feature sets over the credit tables: canonical, second and summarise-everything.

Every function takes DataFrames with the column names of the CSV files and
returns one row per applicant (or loan). Columns a table brings beyond the
named ones are rolled up by their type. Cleaned detail rows are written once
before they are rolled up: the category scan and the column passes of a wide
rollup then read columns instead of parsing the source again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.functions import rowwise as rw
from featloom.functions.values import clamp_zero, difference, ratio
from featloom.operators.assemble import stack_labelled, star_join
from featloom.operators.clean import (
    apply_null_rules,
    categorical_columns,
    columns_matching,
    exclude_values,
    exclude_where,
    non_finite_to_null,
    numeric_columns,
)
from featloom.operators.encode import (
    AlphabeticalCodes,
    FirstSeenCodes,
    OneHot,
    TargetMean,
    fill_derived_with_mean,
    group_median_lookup,
    narrow_text_columns,
    observed_categories,
)
from featloom.operators.rollup import (
    RollupSpec,
    category_columns,
    category_shares,
    quoted,
    rollup,
    rollup_with_subsets,
    status_history,
    summarise_all,
)
from featloom.plans import credit_spec as spec
from featloom.sources.tables import first_rows
from featloom.workspace import discard, materialise, settle, tables_written

KEY, LOAN, PREVIOUS, LABEL = spec.KEY, spec.LOAN, spec.PREVIOUS, spec.LABEL
IDS = (KEY, LOAN, PREVIOUS)


def with_formulas(df: DataFrame, formulas: dict[str, str]) -> DataFrame:
    return df.select("*", *[F.expr(f"{sql} AS {quoted(name)}") for name, sql in formulas.items()])


def with_missing_count(df: DataFrame, name: str, label: str | None = None) -> DataFrame:
    """Null cells per row over all columns but the label."""
    return df.withColumn(name, rw.row_null_count([c for c in df.columns if c != label]))


def _shares(df: DataFrame, null_column: bool = False) -> dict[str, list]:
    """Categories per text column; ``null_column`` adds a null share even where no null occurs.

    A column with more values than a wide table can hold is left to ``category_shares``.
    """
    text = narrow_text_columns(df, categorical_columns(df))
    found = observed_categories(df, text) if text else {}
    if null_column:
        found = {c: [v for v in vs if v is not None] + [None] for c, vs in found.items()}
    return found


def _divided(df: DataFrame, prefix: str, left_out: list[DataFrame] | None, null_column: bool = False, subsets: tuple[str, dict] | None = None) -> dict[str, list]:
    """``_shares``; the shares of the columns it leaves out are appended to ``left_out`` in long form, with the prefix.

    ``subsets`` (status column, value by prefix) adds the same of the rows with each status. Without a list to append to
    such a column is an error.
    """
    found = _shares(df, null_column)
    wide = [c for c in categorical_columns(df) if c not in found]
    if wide and left_out is None:
        raise ValueError(f"{wide} have more values than a wide table can hold: pass left_out to get their shares in long form")
    if wide:
        status, values = subsets or ("", {})
        parts = {prefix: df} | {p: df.where(F.col(status) == v) for p, v in values.items()}
        left_out += [category_shares(part, KEY, wide).withColumn("prefix", F.lit(p)) for p, part in parts.items()]
    return found


def rollup_everything(
    df: DataFrame, prefix: str, count_as: str, drop: Sequence[str] = (), left_out: list[DataFrame] | None = None, subsets: tuple[str, dict] | None = None
) -> RollupSpec:
    """Five statistics of each number and the share of each category, per applicant."""
    numbers = [c for c in numeric_columns(df) if c not in (*IDS, *drop)]
    return RollupSpec(KEY, prefix, {c: spec.ALL_SIX for c in numbers}, _divided(df, prefix, left_out, subsets=subsets), count_as)


# --- canonical set ----------------------------------------------------------------------------


def application(train: DataFrame, test: DataFrame) -> DataFrame:
    everyone = stack_labelled(train, test)
    encoder = TargetMean.fit(train, categorical_columns(train), LABEL)
    df = exclude_values(everyone, spec.EXCLUDED_APPLICANTS)
    df = encoder.transform(df).drop(*spec.DROPPED_DOCUMENTS)
    df = apply_null_rules(df, spec.APPLICATION_NULLS)
    df = with_missing_count(df, "app_missing", LABEL)
    df = df.withColumn("app_EXT_SOURCE_mean", rw.row_mean(spec.SOURCES))
    df = with_formulas(rw.with_row_std(df, spec.SOURCES, "app_EXT_SOURCE_std"), spec.APPLICATION_FEATURES)
    return fill_derived_with_mean(df, "app_EXT_SOURCE_std")


def bureau_balance(balance: DataFrame) -> DataFrame:
    """One row per loan: its history, the share of each status and the months covered."""
    statuses = observed_categories(balance, ["STATUS"])["STATUS"]
    same = lambda v: F.col("STATUS").eqNullSafe(F.lit(v)).cast("int")
    history = status_history(
        balance,
        LOAN,
        "MONTHS_BALANCE",
        "STATUS",
        spec.STATUS_CLOSED,
        spec.STATUS_COUNTED,
        spec.STATUS_LATE,
        statuses=statuses,
        also=[
            F.min("MONTHS_BALANCE").alias("MONTHS_BALANCE_MIN"),
            F.max("MONTHS_BALANCE").alias("MONTHS_BALANCE_MAX"),
            F.count("*").alias("MONTHS_BALANCE_SIZE"),
            *[F.avg(same(v)).alias(f"{name}_MEAN") for name, (_, v) in category_columns({"STATUS": statuses}).items()],
        ],
    )
    ends = {c: list(statuses) for c in ("First_status", "Last_status")}
    return OneHot(ends).transform(history)


def bureau(loans: DataFrame, balance: DataFrame, left_out: list[DataFrame] | None = None) -> DataFrame:
    df = apply_null_rules(loans, spec.BUREAU_NULLS)
    df = exclude_where(df, F.col("DAYS_ENDDATE_FACT") < F.col("DAYS_CREDIT"))
    df = with_formulas(df, spec.BUREAU_FEATURES)
    loan_features = bureau_balance(balance)
    joined = materialise(df.join(loan_features, LOAN, "left").drop(LOAN), "bureau")
    everything = rollup_everything(joined, "BURO_", "BURO_COUNT", left_out=left_out, subsets=("CREDIT_ACTIVE", spec.BUREAU_SUBSETS))
    # Shares of a loan are averaged over the applicant's loans, nothing else.
    shares = {c for c in loan_features.columns if c.startswith(("STATUS_", "First_status", "Last_status"))}
    measures = {c: (["mean"] if c in shares else f) for c, f in everything.measures.items()}
    return rollup_with_subsets(
        joined,
        RollupSpec(KEY, "BURO_", measures, everything.shares, "BURO_COUNT"),
        "CREDIT_ACTIVE",
        spec.BUREAU_SUBSETS,
    )


def previous_application(prev: DataFrame, left_out: list[DataFrame] | None = None) -> DataFrame:
    df = with_missing_count(apply_null_rules(prev, spec.PREVIOUS_NULLS), "prev_missing")
    df = materialise(with_formulas(df, spec.PREVIOUS_FEATURES), "detail")
    everything = rollup_everything(df, "PREV_", "PREV_COUNT", left_out=left_out, subsets=("NAME_CONTRACT_STATUS", spec.PREVIOUS_SUBSETS))
    return rollup_with_subsets(df, everything, "NAME_CONTRACT_STATUS", spec.PREVIOUS_SUBSETS)


def pos_cash(pos: DataFrame, left_out: list[DataFrame] | None = None) -> DataFrame:
    df = with_formulas(apply_null_rules(pos, spec.POS_NULLS), spec.POS_FEATURES)
    return rollup(df, rollup_everything(df, "POS_", "POS_COUNT", left_out=left_out))


def instalments(payments: DataFrame, left_out: list[DataFrame] | None = None) -> DataFrame:
    df = materialise(with_formulas(apply_null_rules(payments, spec.INSTALMENT_NULLS), spec.INSTALMENT_FEATURES), "detail")
    return rollup(df, rollup_everything(df, "INS_", "INSTAL_COUNT", left_out=left_out))


def card_balance(card: DataFrame, left_out: list[DataFrame] | None = None) -> DataFrame:
    df = with_missing_count(apply_null_rules(card, spec.CARD_NULLS), "card_missing")
    df = materialise(with_formulas(df, spec.CARD_FEATURES), "detail")
    return rollup(df, rollup_everything(df, "CARD_", "CARD_COUNT", left_out=left_out))


def settled(rollup_of: Callable[..., DataFrame], *tables: DataFrame, left_out: list[DataFrame] | None = None) -> DataFrame:
    """The rollup written, without the tables it was made from; what it leaves out is written as well.

    Rollups that are joined unwritten run in one stage, whose tasks hold the memory of all their aggregates and sorts at the
    same time, over the detail rows and shuffles of all tables.
    """
    before = len(left_out or ())
    with tables_written() as used:
        rolled = rollup_of(*tables) if left_out is None else rollup_of(*tables, left_out)
    if left_out is not None:
        left_out[before:] = [materialise(shares, "shares") for shares in left_out[before:]]
    return settle(rolled, "rollup", *used)


def canonical_features(tables: dict[str, DataFrame], left_out: list[DataFrame] | None = None) -> DataFrame:
    """Wide table, one row per applicant; tables are keyed by their file names.

    ``left_out`` gets the shares of text columns with too many values for it, one long table (KEY, column, value, share,
    prefix) for each rollup that has such columns.
    """
    return star_join(
        application(tables["application_train"], tables["application_test"]),
        [
            settled(bureau, tables["bureau"], tables["bureau_balance"], left_out=left_out),
            settled(previous_application, tables["previous_application"], left_out=left_out),
            settled(pos_cash, tables["POS_CASH_balance"], left_out=left_out),
            settled(instalments, tables["installments_payments"], left_out=left_out),
            settled(card_balance, tables["credit_card_balance"], left_out=left_out),
        ],
        KEY,
    )


# --- second set -------------------------------------------------------------------------------


def document_flags(df: DataFrame) -> list[str]:
    return columns_matching(df, "FLAG_DOC")


def live_flags(df: DataFrame) -> list[str]:
    """Numeric flags that are neither document flags nor have FLAG in the middle of the name."""
    numeric = set(numeric_columns(df))
    return [c for c in columns_matching(df, "FLAG_", "FLAG_DOC|_FLAG_") if c in numeric]


def second_application(train: DataFrame, test: DataFrame) -> DataFrame:
    df = exclude_values(stack_labelled(train, test), {"CODE_GENDER": "XNA"})
    df = apply_null_rules(df, [r for r in spec.APPLICATION_NULLS if r.column == "DAYS_EMPLOYED"])
    df = materialise(df, "application")
    df = rw.with_row_kurtosis_sample(df, document_flags(df), "NEW_DOC_IND_KURT")
    df = df.withColumn("NEW_LIVE_IND_SUM", rw.row_sum(live_flags(df)))
    df = group_median_lookup(df, "ORGANIZATION_TYPE", "AMT_INCOME_TOTAL", "NEW_INC_BY_ORG")
    df = df.withColumn("NEW_EXT_SOURCES_MEAN", rw.row_mean(spec.SOURCES))
    df = with_formulas(rw.with_row_std(df, spec.SOURCES, "NEW_SCORES_STD"), spec.SECOND_APPLICATION_FEATURES)
    df = fill_derived_with_mean(df, "NEW_SCORES_STD")
    for codes in FirstSeenCodes.fit_all(df, spec.SECOND_BINARY, KEY):
        df = codes.transform(df)
    df = OneHot.fit(df, categorical_columns(df), null_column="never").transform(df)
    return df.drop(*spec.DROPPED_DOCUMENTS_SECOND)


def second_bureau(loans: DataFrame, balance: DataFrame, left_out: list[DataFrame] | None = None) -> DataFrame:
    months = rollup(
        balance,
        RollupSpec(LOAN, "", {"MONTHS_BALANCE": ["min", "max"]}, _divided(balance, "", None, True), "MONTHS_BALANCE_SIZE"),
    )
    joined = materialise(loans.join(months, LOAN, "left").drop(LOAN), "bureau")
    status = [c for c in months.columns if c.startswith("STATUS_")]
    # The status shares belong to the overall rollup only, so they are computed apart from the subsets.
    main = rollup_with_subsets(
        joined,
        RollupSpec(KEY, "BURO_", spec.SECOND_BUREAU, _divided(joined, "BURO_", left_out, True)),
        "CREDIT_ACTIVE",
        spec.BUREAU_SUBSETS,
        subset_shares=False,
    )
    return main.join(rollup(joined, RollupSpec(KEY, "BURO_", {c: ["mean"] for c in status})), KEY, "left")


def second_previous(prev: DataFrame, left_out: list[DataFrame] | None = None) -> DataFrame:
    df = apply_null_rules(prev, spec.PREVIOUS_SENTINELS)
    df = df.withColumn("APP_CREDIT_PERC", ratio("AMT_APPLICATION", "AMT_CREDIT"))
    return rollup_with_subsets(
        df,
        RollupSpec(KEY, "PREV_", spec.SECOND_PREVIOUS, _divided(df, "PREV_", left_out, True)),
        "NAME_CONTRACT_STATUS",
        spec.PREVIOUS_SUBSETS,
        subset_shares=False,
    )


def second_pos_cash(pos: DataFrame, left_out: list[DataFrame] | None = None) -> DataFrame:
    return rollup(pos, RollupSpec(KEY, "POS_", spec.SECOND_POS, _divided(pos, "POS_", left_out, True), "POS_COUNT"))


def with_payment_features(payments: DataFrame, null_as_zero: bool) -> DataFrame:
    """Paid share, shortfall, days past due and days before due."""
    late = difference("DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT")
    return payments.withColumns(
        {
            "PAYMENT_PERC": ratio("AMT_PAYMENT", "AMT_INSTALMENT"),
            "PAYMENT_DIFF": difference("AMT_INSTALMENT", "AMT_PAYMENT"),
            "DPD": clamp_zero(late, null_as_zero),
            "DBD": clamp_zero(-late, null_as_zero),
        }
    )


def second_instalments(payments: DataFrame, left_out: list[DataFrame] | None = None) -> DataFrame:
    df = with_payment_features(payments, null_as_zero=True)
    return rollup(df, RollupSpec(KEY, "INSTAL_", spec.SECOND_INSTALMENTS, _divided(df, "INSTAL_", left_out, True), "INSTAL_COUNT"))


def second_card_balance(card: DataFrame) -> DataFrame:
    encoded = OneHot.fit(card, categorical_columns(card), null_column="always").transform(card)
    return summarise_all(encoded, KEY, spec.SECOND_CARD, "CC_", [PREVIOUS], "CC_COUNT")


def second_features(tables: dict[str, DataFrame], rows: int | None = None, left_out: list[DataFrame] | None = None) -> DataFrame:
    """``rows`` limits every table to its first rows in key order, for debugging.

    The other columns break ties, so the sample is the same on every run. ``left_out`` as in the canonical set.
    """
    keys = {"bureau": LOAN, "bureau_balance": LOAN}

    def sample(name: str, df: DataFrame) -> DataFrame:
        key = keys.get(name, KEY)
        return first_rows(df, [key, *[c for c in df.columns if c != key]], rows)

    t = {name: sample(name, df) for name, df in tables.items()}
    return star_join(
        second_application(t["application_train"], t["application_test"]),
        [
            settled(second_bureau, t["bureau"], t["bureau_balance"], left_out=left_out),
            settled(second_previous, t["previous_application"], left_out=left_out),
            settled(second_pos_cash, t["POS_CASH_balance"], left_out=left_out),
            settled(second_instalments, t["installments_payments"], left_out=left_out),
            settled(second_card_balance, t["credit_card_balance"]),
        ],
        KEY,
    )


# --- summarise-everything set -----------------------------------------------------------------


def with_codes(df: DataFrame) -> DataFrame:
    """Every text column as its alphabetical code."""
    text = categorical_columns(df)
    for codes in AlphabeticalCodes.fit_all(df, text) if text else []:
        df = codes.transform(df)
    return df


def summary(df: DataFrame, key: str, prefix: str, drop: Sequence[str] = (), settled: bool = False) -> DataFrame:
    """``settled`` writes the rollup and lets its detail rows go, for a caller that goes on to other tables."""
    coded = materialise(with_codes(df), "detail")
    rolled = summarise_all(coded, key, spec.SUMMARY_FUNCTIONS, prefix, drop)
    return settle(rolled, "rollup", coded) if settled else rolled


STABLE_DIGITS = 6


def summary_bureau(loans: DataFrame, balance: DataFrame, settled: bool = False) -> DataFrame:
    of_loans = summary(balance, LOAN, "BAL_", settled=settled)
    # The last bits of a deviation depend on the order of its sum; the distinct count must not.
    months = of_loans.withColumns({c: F.round(c, STABLE_DIGITS) for c in of_loans.columns if c.endswith("_STD")})
    rolled = summary(loans.join(months, LOAN, "left"), KEY, "BUR_", [LOAN], settled)
    if settled:
        discard(of_loans)
    return rolled


def summary_previous(prev: DataFrame, settled: bool = False) -> DataFrame:
    df = apply_null_rules(prev, spec.PREVIOUS_SENTINELS)
    return summary(df.withColumn("APP_CREDIT_PERC", ratio("AMT_APPLICATION", "AMT_CREDIT")), KEY, "PRE_", [PREVIOUS], settled)


ORGANIZATION, INCOME_BY_ORGANIZATION = "ORGANIZATION_TYPE", "NEW_INC_BY_ORG"


def summary_formulas(df: DataFrame, documents: Sequence[str], live: Sequence[str]) -> DataFrame:
    """Row features of the joined table, which brings its median lookup; the missing count covers the rollups as well."""
    df = df.withColumn("na", rw.row_null_count([c for c in df.columns if c not in (LABEL, INCOME_BY_ORGANIZATION)]))
    df = apply_null_rules(df, [r for r in spec.APPLICATION_NULLS if r.column == "DAYS_EMPLOYED"])
    df = with_formulas(df, spec.SUMMARY_APPLICATION_FEATURES)
    df = rw.with_row_kurtosis_moment(df, list(documents), "DOC_IND_KURT")
    df = df.withColumn("LIVE_IND_SUM", rw.row_sum(list(live), skip_nulls=False))
    rest = [c for c in df.columns if c not in (ORGANIZATION, INCOME_BY_ORGANIZATION)]
    df = df.select(*[quoted(c) for c in (ORGANIZATION, *rest, INCOME_BY_ORGANIZATION)])
    df = df.withColumn("NEW_EXT_SOURCES_MEAN", rw.row_mean(spec.SOURCES, skip_nulls=False))
    df = rw.with_row_std(df, spec.SOURCES, "NEW_SCORES_STD", skip_nulls=False)
    return non_finite_to_null(df)


def summary_application(train: DataFrame, test: DataFrame, rollups: Sequence[DataFrame] = ()) -> DataFrame:
    base = materialise(with_codes(stack_labelled(train, test)), "application")
    documents, live = document_flags(base), columns_matching(base, "FLAG_", "FLAG_DOC")
    # The lookup reads the applicants alone; after the joins it would need the wide rows written or joined twice.
    base = group_median_lookup(base, ORGANIZATION, "AMT_INCOME_TOTAL", INCOME_BY_ORGANIZATION)
    return summary_formulas(star_join(base, rollups, KEY), documents, live)


def summary_features(tables: dict[str, DataFrame]) -> DataFrame:
    """The rollups are settled one after another, the largest detail first, so that the disk holds one table's shuffles at a time."""
    payments = with_payment_features(tables["installments_payments"], null_as_zero=False)
    card = summary(tables["credit_card_balance"], KEY, "CARD_", [PREVIOUS], settled=True)
    of_bureau = summary_bureau(tables["bureau"], tables["bureau_balance"], settled=True)
    paid = summary(payments, KEY, "PAY_", [PREVIOUS], settled=True)
    previous = summary_previous(tables["previous_application"], settled=True)
    pos = summary(tables["POS_CASH_balance"], KEY, "POS_", [PREVIOUS], settled=True)
    return summary_application(tables["application_train"], tables["application_test"], [of_bureau, card, paid, pos, previous])
