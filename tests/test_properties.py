"""Property checks of the scalar functions against plain-Python definitions.

Each property draws a list of inputs with hypothesis and checks all of them in
one Spark job (a job per example would be slow).
"""

import hashlib
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera import config as C
from tessera.functions import exprs as X
from tessera.operators import quality

ASCII_WS = " \t\n\r\x0b\x0c"
SETTINGS = settings(max_examples=5, deadline=None)


def band(m):
    if m is None or m < 0:
        return C.TAT_BAND_INVALID
    for upper, label in C.TAT_BANDS:
        if m <= upper:
            return label
    return C.TAT_BAND_OVER


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(-1e5, 1e5, allow_nan=False),
                          st.sampled_from([0.0, 60.0, 60.0000001, 240.0, 1440.0, 4320.0, 4320.5])),
                min_size=1, max_size=60))
def test_tat_band_matches_definition(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, m double")
    got = {r.i: r.b for r in df.select("i", X.tat_band("m").alias("b")).collect()}
    assert got == {i: band(v) for i, v in enumerate(values)}


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet=ASCII_WS + "0123456789aZ", max_size=12)),
                min_size=1, max_size=60))
def test_patient_id_check_matches_definition(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p string")
    got = {r.i: r.ok for r in df.select(
        "i", quality.valid_patient_id("p").alias("ok")).collect()}
    want = {}
    for i, v in enumerate(values):
        s = None if v is None else v.strip(ASCII_WS)
        want[i] = bool(s) and s.isdigit() and len(s) == C.PATIENT_ID_LENGTH
    assert got == want


@SETTINGS
@given(st.lists(st.text(alphabet="abcXYZ 019-_", min_size=0, max_size=20), min_size=1, max_size=40))
def test_hash_keys_match_hashlib(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", X.surrogate_key("v").alias("k"), X.pseudonym("v").alias("p")).collect()
    for r in rows:
        v = values[r.i].encode()
        assert r.k == int(hashlib.md5(v).hexdigest()[:8], 16)
        assert r.p == hashlib.sha256(v).hexdigest()[:16].upper()


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(0, 10**9)), min_size=1, max_size=40))
def test_percent_text_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame([(i, p, f) for i, (p, f) in enumerate(pairs)],
                               "i int, p long, f long")
    got = {r.i: r.t for r in df.select("i", X.percent_text("p", "f").alias("t")).collect()}
    for i, (p, f) in enumerate(pairs):
        x = Fraction(1000 * p, max(p + f, 1)) + Fraction(1, 2)
        tenths = x.numerator // x.denominator
        assert got[i] == f"{tenths // 10}.{tenths % 10}%"


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(list(C.MODALITY_VOCABULARY)),
                          st.text(alphabet="CTMRIXctmrix -", max_size=6)),
                min_size=1, max_size=60))
def test_modality_lookup_matches_definition(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, m string")
    got = {r.i: r.s for r in df.select("i", quality.standard_modality("m").alias("s")).collect()}
    for i, v in enumerate(values):
        key = None if v is None else v.strip(ASCII_WS)
        assert got[i] == (C.MODALITY_VOCABULARY.get(key) if key else None)
