import itertools
import re

import numpy as np
import pytest
from tapeline.llm import queries
from tapeline.llm.licenses import TEMPLATES, WORD, Template, align, longest_increasing, notices, scan_licenses

SF = "/root/testdata/sf0.01"
READY = [Template(n, t, 0.75) for n, t in TEMPLATES]
LINES = {
    "MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-only": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "LicenseRef-All-Rights-Reserved": "All rights reserved.",
}


def test_longest_increasing_by_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(200):
        v = rng.permutation(9)[: rng.integers(0, 9)].tolist()
        at = longest_increasing(v)
        got = [v[i] for i in at]
        assert at == sorted(at) and got == sorted(got)
        best = max((n for n in range(len(v) + 1) for c in itertools.combinations(v, n) if list(c) == sorted(c)), default=0)
        assert len(got) == best


def common_length(a, b):
    """Longest common subsequence, the bound of any alignment."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = [str(x) for x in rng.integers(0, 30, rng.integers(0, 25))]
        b = [w for w in a if rng.random() > 0.2] + [str(x) for x in rng.integers(0, 30, 3)]
        pairs = align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p < r and q < s for (p, q), (r, s) in zip(pairs, pairs[1:]))
        assert len(pairs) <= common_length(a, b)
    unique = [str(i) for i in range(50)]
    some = [w for w in unique if int(w) % 7]
    assert len(align(unique, some)) == common_length(unique, some) == len(some)


@pytest.mark.parametrize("name,text", TEMPLATES)
def test_each_template_is_found_with_noise(name, text):
    words = text.split()
    noisy = " ".join(words[: len(words) // 2] + (["inserted"] if len(words) > 8 else []) + words[len(words) // 2 :])
    filler = "gate step evidence of the module under review and so on. " * 5
    whole = filler + noisy + "\n" + filler + noisy + " " + noisy + " end"
    got = notices(whole, READY, 0.75, 0.6)
    assert [g[2] for g in got] == [name] * 3
    assert all(whole[s:e].startswith(WORD.search(text).group()) for s, e, *_ in got)


def test_no_notice_in_plain_texts():
    assert notices("the license of the module is under review in version 3 of the public plan", READY, 0.75, 0.6) == []
    assert notices("", READY, 0.75, 0.6) == []


def test_every_notice_of_the_documents(spark):
    rows = queries.QUERIES["op8_patience_license_scan"](spark, SF).collect()
    got = {(r.doc_id, r.start, r.license) for r in rows}
    want = set()
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for name, line in LINES.items():
            want |= {(d.doc_id, m.start(), name) for m in re.finditer(re.escape(line), d.text)}
    assert want and want <= got
    assert len(got - want) < 0.05 * len(got)


def test_edge_rows(frame):
    rows = [(1, None), (2, ""), (None, LINES["MIT"]), (4, LINES["MIT"]), (4, LINES["MIT"]), (5, "license " * 40_000), (6, LINES["MIT"].upper() * 2)]
    got = scan_licenses(frame(rows)).collect()
    assert sorted((r.path is None, r.path or 0, r.start) for r in got) == [(False, 4, 0), (False, 4, 0), (False, 6, 0), (False, 6, 31), (True, 0, 0)]
    assert scan_licenses(frame([])).collect() == [] == scan_licenses(frame(rows), []).collect()
