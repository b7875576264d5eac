import hashlib
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from snapdeck.llm import licenses, secret_scan
from snapdeck.llm.secret_scan import EntropyRule

ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute_base(text):
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(ASSIGN, text) if len(m.group(2)) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return [(k, a, b) for a, _, k, b in sorted(out)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "Secret", "api_key", "apikey", "AKIA", "=", ":", " ", '"', "ABCDEF0123456789XY", "0123456789abcdef", "f", "é", "ſ", "x-"]), max_size=14).map("".join))
def test_rules(text):
    assert secret_scan.base_spans(text) == brute_base(text)


def test_entropy_counts_are_kept_up():
    text = "q8Zr2LmP0xT5vKc9YwB3nHd7JfGs4" * 2 + "aaaaaaaaaaaaaaaaaaaaaaaa"
    rule = EntropyRule()
    hot = set()
    for i in range(len(text) - rule.window + 1):
        w = text[i : i + rule.window]
        h = -sum(w.count(c) / len(w) * math.log2(w.count(c) / len(w)) for c in set(w))
        if re.search("[0-9]", w) and re.search("[A-Za-z]", w):
            mixed = re.search("[a-z]", w) and re.search("[A-Z]", w)
            limit = rule.base64_bits if mixed else rule.hex_bits if re.fullmatch("[0-9a-fA-F]+", w) else rule.base36_bits
            if h >= limit - 1e-12:
                hot |= set(range(i, i + rule.window))
    got = {k for a, b in secret_scan.entropy_windows(text, rule) for k in range(a, b)}
    assert got == hot and hot


def test_allow_list_and_cover():
    find = lambda t: secret_scan.find_spans(t, EntropyRule())
    assert find("key q8Zr2LmP0xT5vKc9YwB3nHd7 here")[1] == [("entropy", 4, 28)]
    assert find("id 123e4567-E89B-12D3-A456-426614174000")[1] == []
    assert find("averyveryverylongwordindeed and-another_one.here")[1] == []
    base, every = find('token = "q8Zr2LmP0xT5vKc9YwB3nHd7"')
    assert base == every == [("assign", 0, 33)]


def test_redaction(odd, none):
    rule = EntropyRule()
    t = 'a token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" b'
    assert secret_scan.redacted(t, rule, "[S]") == 'a [S]" b'
    assert secret_scan.redacted("clean", rule, "[S]") == "clean"
    kept = secret_scan.redact(odd)
    assert kept.columns == odd.columns and sorted(map(str, kept.collect())) == sorted(map(str, odd.collect()))
    assert secret_scan.redact(none).count() == 0


def test_scan_frame(odd, none, documents):
    for df in (odd, documents):
        got = secret_scan.scan(df).collect()
        want = []
        for r in df.collect():
            b = brute_base(r.text or "")
            n = [sum(k == kind for k, _, _ in b) for kind in ("assign", "access", "hex")]
            want.append((r.doc_id, *n, hashlib.sha256(",".join(f"{k}:{x}:{y}" for k, x, y in b).encode()).hexdigest()))
        assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
        assert any(r[1] for r in want) == any("token" in (r.text or "") for r in df.collect())
    assert secret_scan.scan(none).count() == 0


def brute_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [
        (i, label)
        for phrase, label in licenses.PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_license_frame(odd, none, documents, spark):
    extra = spark.createDataFrame(
        [(1, "Released under the MIT License."), (2, "cc by nc cc-BY/nc"), (3, "Licensd under the Apach License, Version 2.0"), (4, "under the mit licenses")],
        "doc_id long, text string",
    )
    for df in (odd, documents, extra):
        got = licenses.scan(df).collect()
        want = [(r.doc_id, *brute_licenses(r.text)) for r in df.collect()]
        assert sorted(map(str, (tuple(r)[:6] for r in got))) == sorted(map(str, want))
        assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)
    by = {r.doc_id: r for r in licenses.scan(extra).collect()}
    assert by[3].labels == "apache-2" and by[3].base_labels == "" and 0.9 < by[3].score < 1
    assert by[3].spans == "apache-2:0:7"
    assert licenses.scan(none).count() == 0


def test_notices_need_a_seed_and_an_edit_bound():
    sc = licenses.Scanner()
    assert sc.scan("this is an essay about licensed drivers and apache helicopters")[5] == ""
    assert sc.scan("licensed under the gnu generl public licence version 3")[5] == "gpl-3"


def test_deciding_words_are_exact():
    sc = licenses.Scanner()
    label = lambda t: sc.scan(t)[5]
    assert label("Licensed under the GNU General Public License, version 2") == "gpl-2"
    assert label("licensed under the Gnu General Public License version 3.") == "gpl-3"
    assert label("licensed under the GNU General Public License, version 1") == ""
    assert label("licensed under the Apache License, Version 1.1") == "apache-1.1"
    assert label("released under the isc license") == "isc" and label("released under the mlt license") == ""
    for form in ("by", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd"):
        found = set(label(f"licensed under CC {form.upper()} 4.0 by us").split(",")) - {"cc-by-nc"}  # the phrase's own
        assert found == {f"cc-{form}"}
    assert label("licensed under CC BY-NC 4.0") == "cc-by-nc"
    assert label("Creative Commons Attribution-NonCommercial-ShareAlike") == "cc-by-nc-sa"
    assert label("Creative Commons Attribution NonCommerical") == "" and label("creative common attribution noncommercial") == "cc-by-nc"
    assert label("GNU Lesser General Public License") == "lgpl" and label("GNU Affero General Public License") == "agpl"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_notices_against_all_stretches():
    """Small texts: a label is found if and only if a stretch is near enough
    and has the deciding words; checked where one stretch alone could be it."""
    r = random.Random(4)
    sc = licenses.Scanner()
    for notice in licenses.NOTICES:
        for _ in range(12):
            text = list(notice.text)
            for _ in range(r.randrange(notice.edits + 3)):
                k = r.randrange(len(text))
                text[k : k + r.randrange(2)] = r.choice(["", "x", "e", "q"])
            text = " ".join("".join(text).split())
            flat = f"aa {text} zz"
            hits = [f for f in sc.fuzzy(flat) if f[2] == notice.label]
            for a, b, _, score in hits:  # what is reported is near enough
                near = [n for n in licenses.NOTICES if n.label == notice.label and edit_distance(flat[a:b], n.text) <= n.edits]
                assert near and score <= 1
            words = iter(text.split(" "))
            if edit_distance(text, notice.text) <= notice.edits and all(w in words for w in notice.exact.split()):
                rivals = [f for f in sc.fuzzy(flat) if f[2] != notice.label]
                assert hits or rivals, (notice, text)


def test_allowed_stretches_hide_nothing_beside_them():
    find = lambda t: secret_scan.find_spans(t, EntropyRule())[1]
    secret = "q8Zr2LmP0xT5vKc9YwB3nHd7"
    digest = "sha256-" + "Zm9vYmFyYmF6cXV4Zm9vYmFyYmF6cXV4Zm9vYmFyYmE="
    assert len(digest) == 51 and find(digest) == [] and find("sha256-" + "0a" * 32) == [("hex", 7, 71)]
    assert find(digest + secret) == [("entropy", 51, 75)]
    assert any(k == "entropy" and a <= 0 and b >= 20 for k, a, b in find(secret + ".EXAMPLE"))
    assert any(k == "entropy" for k, _, _ in find("EXAMPLE" + secret))
    assert any(k == "entropy" for k, _, _ in find("sha256-" + secret))
    uuid = "123e4567-E89B-12D3-A456-426614174000"
    assert find(f"{uuid}/{secret}") == [("entropy", 37, 61)] or find(f"{uuid}/{secret}") == [("entropy", 36, 61)]
    assert find("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY") == []
