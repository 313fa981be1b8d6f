import hashlib

from small_tables import SMALL, rows
from checks.registry import raw_loans
from ledgerlark import schema as S
from ledgerlark.operators import identity as I

DDL = ", ".join(f"{c} {S.RAW_COLUMNS[c]}" for c in S.IDENTITY_COLUMNS)
FULL = ("title", "2 years", "OWN", 55000.0, "190xx", "PA", "C", "C4", "Verified")
NONE = (None,) * 9


def keys(spark, given, **options):
    df = spark.createDataFrame(given, DDL)
    return [r.name_sha2 for r in I.member_identity(df, **options).collect()]


def test_key_is_hash_of_joined_text(spark):
    text = "title||2 years||OWN||55000.0||190xx||PA||C||C4||Verified"
    assert keys(spark, [FULL]) == [hashlib.sha256(text.encode()).hexdigest()]


def test_all_null_gives_hash_of_empty_text(spark):
    (key,) = keys(spark, [NONE])
    assert key == hashlib.sha256(b"").hexdigest()
    assert key.startswith(S.EMPTY_IDENTITY_PREFIX)


def test_null_is_skipped_unless_strict(spark):
    one = ("x", None, *FULL[2:])
    other = (None, "x", *FULL[2:])
    loose, strict = keys(spark, [one, other]), keys(spark, [one, other], strict=True)
    assert loose[0] == loose[1]
    assert strict[0] != strict[1]


def test_split_columns(spark):
    keyed = I.member_identity(raw_loans(spark, SMALL))
    assert tuple(I.split_customers(keyed).columns) == S.CUSTOMERS_SOURCE
    assert tuple(I.split_loans(keyed).columns) == S.LOANS_SOURCE
    assert tuple(I.split_repayments(keyed).columns) == S.REPAYMENTS_SOURCE
    assert tuple(I.split_defaulters(keyed).columns) == S.DEFAULTERS_SOURCE
    assert rows(I.split_customers(keyed).select("country").distinct()) == [("USA",)]
