import hmac
from hashlib import sha256

import pytest

from vigil.operators import privacy
from vigil.operators.privacy import Key

VALUES = ["555-0100", "", "žluť", None, "x" * 5000, "555-0100"]


@pytest.mark.parametrize("secret", [b"k", b"\x00\xff" * 32, b"long" * 40])
def test_pseudonyms_are_hmac(spark, secret):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, phone string")
    got = privacy.keyed_digests(df, ["phone"], Key("v2", secret)).orderBy("i").collect()
    want = [v if v is None else "v2:" + hmac.new(secret, v.encode(), sha256).hexdigest() for v in VALUES]
    assert [r.phone_pseudonym for r in got] == want


def test_same_key_joins_and_another_does_not(spark):
    df = spark.createDataFrame([(v,) for v in set(VALUES) - {None}], "phone string")
    one, again, other = (
        privacy.keyed_digests(df, ["phone"], Key("v1", secret)).select("phone_pseudonym")
        for secret in (b"a", b"a", b"b")
    )
    assert one.join(again, "phone_pseudonym").count() == 4
    assert one.join(other, "phone_pseudonym").count() == 0


def test_the_key_is_not_shown(spark):
    key = Key("v1", b"topsecret")
    df = privacy.keyed_digests(spark.createDataFrame([("1",)], "phone string"), ["phone"], key)
    shown = df._jdf.queryExecution().toString().lower() + repr(key)
    for hidden in (b"topsecret", *key.pads()):
        assert hidden.hex() not in shown and hidden[:9].hex() not in shown
    assert "topsecret" not in shown
