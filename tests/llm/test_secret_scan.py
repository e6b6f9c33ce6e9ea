import re

from llm_fixtures import *  # noqa: F401,F403
from tessera.llm import secret_scan as op

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def brute(text):
    t = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


HEX = "0123456789abcdef" * 2
TEXTS = [
    "password = hunter22 and API_KEY:'abc.def-1' PASSWD\"='x12345'", "secret=token:abcdefgh", "token=abc token=abcdef",
    "AKIA" + "A" * 16, "xAKIAAKIA" + "B1" * 9, "AKIA" + "a" * 20, HEX, "é😀 " + HEX + "g" + HEX[:23], HEX + " password: " + HEX,
    "token=" + HEX, "ſecret=abcdef toKen=abcdef", "", None, "plain", "a" * 30_000 + " api_key=zzzzzz", "secret==abcdef",
    "password=aaaaaa " * 3000]


def test_matches_brute_force_with_repeats_and_nulls(spark, frame, scratch):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[0]), (50, TEXTS[0])]
    got = op.secret_scan(spark, frame(rows), f"{scratch}/ledger").collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.path, []).append([tuple(x) for x in r.found])
    for i, t in rows:
        assert brute(t) in by[i], (i, t)


def test_only_unseen_pairs_are_scanned(spark, frame, scratch):
    ledger = f"{scratch}/ledger"
    old = [(i, t) for i, t in enumerate(TEXTS[:6])]
    assert op.update_ledger(spark, frame(old + [(9, TEXTS[0])]), ledger) == 6 * 3
    assert op.update_ledger(spark, frame(old), ledger) == 0
    assert op.update_ledger(spark, frame(old + [(7, "new token=abcdefg")]), ledger) == 3
    newer = (op.RULES[0], op.Rule("access", 2, "AKIA[A-Z0-9]{4,}", 0, 8), op.RULES[2])
    assert op.update_ledger(spark, frame(old), ledger, rules=newer) == 6  # one rule version, six blobs
    found = {r.path: [x.kind for x in r.found] for r in op.findings(spark, frame(old), ledger, rules=newer).collect()}
    assert found[4] == ["access"] and found[0] == ["assign"] * 3
    assert {r.path: [x.kind for x in r.found] for r in op.findings(spark, frame(old), ledger).collect()}[3] == ["access"]


def test_empty_table(spark, frame, scratch):
    assert op.secret_scan(spark, frame([]), f"{scratch}/ledger").count() == 0


def test_regex_runs_above_the_ledger_join_and_without_python(spark, frame, scratch):
    op.update_ledger(spark, frame([(1, "a")]), f"{scratch}/ledger")
    plan = op.findings(spark, frame([(1, "a")]), f"{scratch}/ledger")._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("ArrowEval", "MapIn", "BatchEvalPython", "FlatMapGroups"))
