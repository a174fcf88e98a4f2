"""What the bank's layers hold: dimensions, streams and rules as data. Names, columns and topics are fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from tierline.operators.checks import Check
from tierline.operators.contracts import Contract, Reconciliation, Reference
from tierline.streaming.consolidate import Consolidation
from tierline.streaming.events import StreamSpec


@dataclass(frozen=True)
class Dimension:
    """tracked columns open a version (type 2); without any, the table is type 1. parents: (column, table, its column)."""

    name: str
    key: str
    columns: tuple[str, ...]
    tracked: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    parents: tuple[tuple[str, str, str], ...] = ()
    close_missing: bool = True

    @property
    def sk(self) -> str:
        return f"{self.name.removeprefix('dim_')}_sk"


_OWNER = ("customer_id", "dim_customer", "customer_id")
_PRODUCT = ("product_code", "dim_product", "product_code")
_BRANCH = ("branch_code", "dim_branch", "branch_code")
_ACCOUNT = ("account_id", "dim_account", "account_id")


def dimensions() -> list[Dimension]:
    """Six dimensions with versions and six without."""
    return [
        Dimension(
            "dim_customer", "customer_id",
            ("cccd", "full_name", "gender", "date_of_birth", "phone", "email", "address", "city", "district", "branch_code", "customer_segment", "kyc_status", "register_date", "is_active"),
            ("phone", "email", "address", "city", "district", "customer_segment", "kyc_status", "branch_code"), ("cccd", "full_name"), (_BRANCH,),
        ),
        Dimension(
            "dim_account", "account_id", ("account_no", "customer_id", "product_code", "branch_code", "account_type", "currency", "balance", "open_date", "close_date", "status"),
            ("balance", "status", "close_date"), ("account_no", "customer_id", "product_code", "branch_code"), (_OWNER, _PRODUCT, _BRANCH),
        ),
        Dimension(
            "dim_branch", "branch_code", ("branch_name", "region", "city", "district", "address", "manager_name", "open_date", "status"),
            ("branch_name", "region", "city", "district", "address", "manager_name", "open_date", "status"), ("branch_name",),
        ),
        Dimension(
            "dim_product", "product_code", ("product_name", "product_group", "product_type", "currency", "is_active", "launch_date"),
            ("product_name", "product_group", "product_type", "currency", "is_active", "launch_date"), ("product_name",),
        ),
        Dimension(
            "dim_merchant", "merchant_id", ("merchant_name", "merchant_category", "mcc_code", "city", "state", "risk_category", "is_active"),
            ("merchant_name", "merchant_category", "mcc_code", "city", "state", "risk_category", "is_active"), ("merchant_name",),
        ),
        Dimension(
            "dim_store", "store_id", ("merchant_id", "store_name", "store_type", "address", "city", "district", "is_active"),
            ("merchant_id", "store_name", "store_type", "address", "city", "district", "is_active"), ("merchant_id", "store_name"), (("merchant_id", "dim_merchant", "merchant_id"),),
        ),
        Dimension("dim_card", "card_id", ("card_no_masked", "customer_id", "account_id", "product_code", "card_type", "card_brand", "credit_limit", "issue_date", "expiry_date", "status"), (), ("customer_id", "card_type"), (_OWNER, _ACCOUNT, _PRODUCT)),
        Dimension("dim_deposit", "deposit_id", ("account_id", "customer_id", "product_code", "principal_amount", "interest_rate", "term_months", "open_date", "maturity_date", "status"), (), ("account_id", "customer_id"), (_ACCOUNT, _OWNER)),
        Dimension("dim_device", "device_id", ("customer_id", "device_type", "device_fingerprint", "operating_system", "ip_address", "is_trusted", "first_seen", "last_seen"), (), ("customer_id", "device_type"), (_OWNER,)),
        Dimension("dim_employee", "employee_id", ("full_name", "branch_code", "role", "hire_date", "salary", "status"), (), ("full_name", "branch_code"), (_BRANCH,)),
        Dimension("dim_loan", "loan_id", ("customer_id", "product_code", "branch_code", "loan_amount", "outstanding_balance", "interest_rate", "term_months", "disbursement_date", "maturity_date", "loan_status"), (), ("customer_id", "loan_amount"), (_OWNER, _BRANCH)),
        Dimension("dim_location", "location_id", ("merchant_name", "merchant_category", "city", "state", "latitude", "longitude", "is_high_risk_area"), (), ("city", "state")),
    ]


def _columns(contract: str) -> dict[str, str]:
    """Columns by name, in the contract's order: a name alone is a text, name:long a number, name:decimal an amount, name:int a flag."""
    kinds = {"": "string", "long": "bigint", "decimal": "decimal(18,2)", "int": "int"}
    return {name: kinds[kind] for name, _, kind in (c.partition(":") for c in contract.split())}


#: The columns of each topic's payload.
_CUSTOMER_COLUMNS = _columns("""
    customer_id:long cccd full_name gender date_of_birth:long phone email address city district branch_code customer_segment kyc_status
    register_date:long is_active last_updated:long""")
_ACCOUNT_COLUMNS = _columns("""
    account_id:long account_no customer_id:long product_code branch_code account_type currency balance:decimal open_date:long close_date:long
    status last_updated:long""")
_TRANSACTION_COLUMNS = _columns("""
    txn_id:long account_id:long customer_id:long txn_date:long txn_amount:decimal txn_type debit_credit balance_after:decimal channel description
    counter_account created_ts:long last_updated:long""")
_CARD_COLUMNS = _columns("""
    card_id:long card_no_masked customer_id:long account_id:long product_code card_type card_brand credit_limit:decimal issue_date:long
    expiry_date:long status last_updated:long""")
_CARD_TRANSACTION_COLUMNS = _columns("""
    txn_id:long card_id:long customer_id:long txn_date:long txn_amount:decimal txn_type currency merchant_name merchant_category channel status
    created_ts:long last_updated:long""")
#: The same for both ways to pay online.
_PAYMENT_COLUMNS = _columns("""
    transaction_id:long account_id:long device_id:long location_id:long customer_id:long transaction_type channel amount:decimal currency is_fraud
    fraud_reason status merchant_id:long payment_channel refund_flag:int transaction_date:long created_ts:long last_updated:long""")


def streams() -> list[StreamSpec]:
    """Seven topics; two are deduplicated, one is enriched."""
    once = (("transaction_id",), "10 minutes")
    return [
        StreamSpec("postgresql.banking.core_banking.customer", ("customer_id",), _CUSTOMER_COLUMNS),
        StreamSpec("postgresql.banking.core_banking.account", ("account_id",), _ACCOUNT_COLUMNS, lookup="br", lookup_keys=("branch_code",)),
        StreamSpec("postgresql.banking.core_banking.txn_account", ("txn_id",), _TRANSACTION_COLUMNS),
        StreamSpec("postgresql.banking.card_crm.card", ("card_id",), _CARD_COLUMNS),
        StreamSpec("postgresql.banking.card_crm.card_txn", ("txn_id",), _CARD_TRANSACTION_COLUMNS),
        StreamSpec("postgresql.banking.digital_banking.online_transaction", ("transaction_id",), _PAYMENT_COLUMNS, *once),
        StreamSpec("qr.payment.events", ("transaction_id",), _PAYMENT_COLUMNS, *once),
    ]


def consolidations() -> list[Consolidation]:
    return [
        Consolidation("dim_customer_current", ("customer_id",), {"date_of_birth": "epoch_days", "register_date": "epoch_days", "is_active": "int", "last_updated": "epoch_micros"}),
        Consolidation("dim_account_current", ("account_id",), {"open_date": "epoch_days", "close_date": "epoch_days", "balance": "decimal", "last_updated": "epoch_micros"}),
        Consolidation("fact_online_transaction_current", ("transaction_id",), {"amount": "decimal"}),
    ]


def rules(dimension: Dimension) -> list[Check]:
    """What every dimension must hold: rows, its key and what is required of it, and one current version a key."""
    base = [Check("row_count", low=1), Check("not_null", dimension.key), Check("unique", dimension.key)]
    return base + [Check("not_null", c) for c in dimension.required] + [Check("not_null", c, severity="WARN") for c in dimension.tracked if c not in dimension.required]


def fact_rules(key: str, amount: str, channels: tuple[str, ...] = ()) -> list[Check]:
    """What every fact must hold: rows, keys once, amounts of 0 or more, no future days, and known channels."""
    base = [Check("row_count", low=1), Check("not_null", key), Check("unique", key), Check("range", amount, low=0), Check("not_future", "cob_dt")]
    return base + ([Check("accepted", "channel", values=channels, severity="WARN")] if channels else [])


def _contract(table: str, key: str, required: str = "", warned: str = "", amount: str = "", references: tuple[Reference, ...] = (), reconciliations: tuple[Reconciliation, ...] = ()) -> Contract:
    """Rows, required columns, a key that is unique, columns that should be there, and an amount of 0 or more."""
    base = [Check("row_count", low=1), Check("not_null", key), *[Check("not_null", c) for c in required.split()], Check("unique", key)]
    base += [Check("not_null", c, severity="WARN") for c in warned.split()] + ([Check("range", amount, low=0, severity="WARN")] if amount else [])
    return Contract(table, tuple(base), references, reconciliations)


_CUSTOMER, _OF_ACCOUNT = Reference("customer_id", "dim_customer", "customer_id"), Reference("account_id", "dim_account", "account_id")
_OF_PRODUCT, _OF_BRANCH = Reference("product_code", "dim_product", "product_code"), Reference("branch_code", "dim_branch", "branch_code")

#: What must hold of each table of the layers.
SILVER_RULES = (
    _contract("dim_customer", "customer_id", "cccd full_name", "phone email address city district branch_code", references=(Reference("branch_code", "dim_branch", "branch_code", "WARN"),), reconciliations=(Reconciliation("core_customer", "customer_id", 5),)),
    _contract("dim_account", "account_id", "account_no customer_id product_code branch_code", amount="balance", references=(_CUSTOMER, _OF_PRODUCT, _OF_BRANCH)),
    _contract("dim_product", "product_code", "product_name"),
    _contract("dim_branch", "branch_code", "branch_name"),
    _contract("dim_card", "card_id", "customer_id card_type", references=(_CUSTOMER, _OF_ACCOUNT, _OF_PRODUCT)),
    _contract("dim_employee", "employee_id", "full_name branch_code", references=(_OF_BRANCH,)),
    _contract("dim_device", "device_id", "customer_id device_type", references=(_CUSTOMER,)),
    _contract("dim_location", "location_id", "merchant_name"),
    _contract("fact_txn_account", "txn_id", "account_id customer_id txn_date txn_amount", amount="txn_amount", references=(_OF_ACCOUNT, _CUSTOMER), reconciliations=(Reconciliation("core_txn_account", "txn_id", 5, "WARN"),)),
    _contract("fact_card_txn", "txn_id", "card_id customer_id txn_date txn_amount", amount="txn_amount", references=(Reference("card_id", "dim_card", "card_id"), _CUSTOMER)),
    _contract("fact_crm_interaction", "interaction_id", "customer_id interaction_date", references=(_CUSTOMER,)),
    _contract("fact_online_transaction", "transaction_id", "customer_id transaction_date amount", amount="amount", references=(_CUSTOMER,)),
    _contract("fact_support_ticket", "ticket_id", "customer_id issue_type priority status", references=(_CUSTOMER,)),
)
#: Marts that must have rows, each with this column; and logs that must have rows.
GOLD_RULES = tuple(
    Contract(table, (Check("row_count", low=1), Check("not_null", column))) for table, column in (
        ("mart_customer_360", "customer_id"), ("customer_balance_summary", "customer_id"), ("customer_card_summary", "customer_id"), ("customer_product_summary", "customer_id"), ("customer_transaction_summary", "customer_id"),
        ("mart_branch_monthly_summary", "branch_code"), ("rfm_segment", "customer_id"), ("churn_prediction", "customer_id"), ("cross_sell_segment", "customer_id"), ("campaign_target", "customer_id"),
    )
)
LOG_RULES = tuple(Contract(t, (Check("row_count", low=1),)) for t in ("core_account_cdc", "core_customer_cdc", "core_transaction_cdc", "card_account_cdc", "card_transaction_cdc", "online_transaction_cdc"))


@dataclass(frozen=True)
class Violation:
    """Rows of a table that go into quarantine; a condition that is unknown (null) is no violation."""

    table: str
    name: str
    severity: str
    condition: str


#: now and today stand for the moment of the check, so that it can be repeated.
QUARANTINE = (
    Violation("dim_customer", "null_required_fields", "FAIL", "customer_id IS NULL OR cccd IS NULL OR full_name IS NULL"),
    Violation("dim_customer", "invalid_phone_format", "WARN", "phone IS NOT NULL AND phone NOT LIKE '0%' AND length(phone) != 10"),
    Violation("dim_customer", "invalid_email_format", "WARN", "email IS NOT NULL AND email NOT LIKE '%@%'"),
    Violation("dim_customer", "invalid_cccd_format", "FAIL", "cccd IS NOT NULL AND length(cccd) != 12"),
    Violation("dim_customer", "future_register_date", "FAIL", "register_date > {today}"),
    Violation("dim_account", "negative_balance", "WARN", "balance < 0 AND account_type = 'CASA'"),
    Violation("dim_account", "zero_balance_active", "WARN", "balance = 0 AND status = 'ACTIVE'"),
    Violation("dim_account", "closed_with_balance", "FAIL", "balance > 0 AND status = 'CLOSED'"),
    Violation("dim_account", "future_open_date", "FAIL", "open_date > {today}"),
    Violation("fact_txn_account", "large_transaction", "WARN", "abs(txn_amount) > 1000000000"),
    Violation("fact_txn_account", "negative_amount", "WARN", "txn_amount < 0 AND txn_type NOT IN ('REFUND', 'REVERSAL')"),
    Violation("fact_txn_account", "zero_amount", "WARN", "txn_amount = 0"),
    Violation("fact_txn_account", "future_transaction_date", "FAIL", "txn_date > {now}"),
    Violation("fact_txn_account", "missing_channel", "WARN", "channel IS NULL OR channel = ''"),
    Violation("dim_account", "inactive_account", "WARN", "status = 'INACTIVE'"),
    Violation("dim_account", "closed_account", "INFO", "status = 'CLOSED'"),
    Violation("dim_branch", "inactive_branch", "INFO", "status = 'INACTIVE' OR status = 'CLOSED'"),
    Violation("dim_branch", "missing_manager", "WARN", "manager_name IS NULL OR manager_name = ''"),
)
