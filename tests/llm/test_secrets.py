import base64
import hashlib
import random
import re
import uuid
from collections import Counter

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from civicspark.llm import secrets as S

from .conftest import documents

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def in_any_case(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def brute(text):
    """The contract's own patterns, every match taken and short ones dropped after."""
    text = text or ""
    names = "|".join(map(in_any_case, ("password", "passwd", "secret", "token"))) + "|" + in_any_case("api") + "_?" + in_any_case("key")
    out = []
    for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        out += [(m.start(), "assign", m.end())] if len(m[2]) >= 12 else []
    for kind, pattern, least in (("access", "AKIA[A-Z0-9]+", 18), ("hex", "[0-9a-f]+", 16)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    order = {"assign": 0, "access": 1, "hex": 2}
    return sorted(out, key=lambda x: (x[0], order[x[1]]))


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.sampled_from(
            ["password", "PassWD", "secret", "toKen", "api_key", "APIKEY", "=", ":", " ", '"', "'", "AKIA", "ABC0123456789XYZ", "deadbeef00", "0123456789abcdef", "x.y-z/+", "é", "ſ", "K", "\n", "q"]
        ),
        max_size=14,
    ).map("".join)
)
def test_known_forms_equal_the_patterns(text):
    assert [(s, S.KINDS[k], e) for s, k, e in S.base_spans(text)] == brute(text)


PLAIN = "where the value of every configuration entry is written by hand, then read again by the service when it starts"
CODE = """def connect(self, host, port=443):
    # the {name} of the deployment
    client = Client(host, port, {name}_value='{value}', timeout=30)
    return client.session(retries=3)
"""


def strings(n, seed):
    draw = random.Random(seed)
    for _ in range(n):
        kind = draw.randrange(4)
        if kind == 0:
            yield "".join(draw.choices(LETTERS + "0123456789", k=draw.randint(20, 44)))
        elif kind == 1:
            yield base64.b64encode(draw.randbytes(draw.randint(18, 36))).decode()
        elif kind == 2:
            yield str(uuid.UUID(int=draw.getrandbits(128)))
        else:
            yield "sk_live_" + "".join(draw.choices(LETTERS + "0123456789", k=24))


HARMLESS = [
    "get_client_session_value2", "configuration_entry_service_v2", "read_the_value_written_by_hand_2", "DeploymentClientTimeout30", "gggggggggggggggggggggg0",
    "service/configuration/entry2/value.written", "zzzzzzzzzzzzzzzzzzzzzzzz1", "port=443.timeout=30",
]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, PLAIN + "\n" + CODE.format(name="key", value=f"v{i}")) for i in range(60)]
    return rows


def test_novel_strings_are_found_and_plain_ones_left(spark, corpus):
    hidden = list(strings(80, 3))
    rows = corpus + [(100 + i, CODE.format(name="credential", value=s) + PLAIN) for i, s in enumerate(hidden)]
    rows += [(1000 + i, CODE.format(name="credential", value=s) + PLAIN) for i, s in enumerate(HARMLESS)]
    rows += [(2000 + i, PLAIN + f" {s} " + PLAIN) for i, s in enumerate(hidden)]  # no sensitive place
    rows += [(3000 + i, f"the key account is at mail{i}server99.example.com and me.{i}Zq8rT2mVx0Lk7WnB4yHd@example.com " + PLAIN) for i in range(5)]
    found = {r["doc_id"]: r["spans"] for r in S.find_secrets(documents(spark, rows)).collect()}
    caught = [any(x["kind"] == "novel" and x["text"] == s for x in found[100 + i]) or bool(brute(dict(rows)[100 + i])) for i, s in enumerate(hidden)]
    assert sum(caught) >= 0.97 * len(hidden)
    assert [HARMLESS[i] for i in range(len(HARMLESS)) if found[1000 + i]] == []
    assert not any(x["kind"] == "novel" for i in range(len(hidden)) for x in found[2000 + i])


def test_measures_equal_plain_compression(spark):
    """The reported share from two compressions done by hand."""
    value = "Zq8rT2mVx0Lk7WnB4yHd"
    text = CODE.format(name="credential", value=value)
    row = S.find_secrets(documents(spark, [(1, text)]), entries=["deployment", "client"]).first()["spans"][0]
    assert (row["kind"], row["text"], row["start"]) == ("novel", value, text.index(value))
    primed = zstandard.ZstdCompressionDict(b"client deployment", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    shrink = zstandard.ZstdCompressor(level=S.LEVEL, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False)
    before, after = text[: row["start"]][-S.AROUND :], text[row["end"] :][: S.AROUND]
    added = len(shrink.compress((before + value + after).encode())) - len(shrink.compress((before + after).encode()))
    assert row["novelty"] == pytest.approx(8 * added / (len(value) * 5.954196310386875))


def test_identifiers_are_counted_over_all_texts(spark, sf_docs):
    want = Counter()
    for r in sf_docs.collect():
        for w in re.split(r"[\W_]+", r["text"] or ""):
            plain = w.isalpha()
            if 4 <= len(w) <= (S.LONGEST_PLAIN if plain else S.LONGEST_MIXED) and w[0].isalpha():
                want[w] += 1
    got = S.identifiers(sf_docs, entries=300)
    ranked = sorted((w for w in want if want[w] > 1), key=lambda w: (-want[w], w))
    assert got == ranked[: len(got)] and 200 < len(got) <= 300
    assert sum(want[w] >= want[ranked[len(got)]] for w in ranked) > 300  # with the next count there would be more


ODD = [
    (1, None), (2, ""), (None, "password=abcdefghijkl"), (3, "AKIA" + "0" * 14 + " " + "f" * 5000), (3, "AKIA" + "0" * 14 + " " + "f" * 5000),
    (4, "tokeN" + " " * 3000 + "= 'x'"), (5, "\U0001f600 secret: abcdef.ghij-kl"), (6, "x " * 50000 + "api_key=0123456789abcdef0"),
]


def test_odd_rows(spark):
    got = Counter((r["doc_id"], joined([(x["start"], x["kind"], x["end"]) for x in r["spans"] if x["kind"] != "novel"])) for r in S.find_secrets(documents(spark, ODD)).collect())
    assert got == Counter((d, joined(brute(t))) for d, t in ODD)


def test_the_query_equals_the_patterns(spark, sf, sf_docs):
    want = Counter()
    for r in sf_docs.collect():
        spans = brute(r["text"])
        kinds = Counter(k for _, k, _ in spans)
        want[(r["doc_id"], kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(joined(spans).encode()).hexdigest())] += 1
    rows = S.op11_secrets(spark, sf).collect()
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in rows) == want
    for r in rows:
        base = [x for x in r["spans"].split(",") if x and not x.startswith("novel")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r["base_sha256"]
        assert len(base) + r["n_novel"] == len([x for x in r["spans"].split(",") if x])


def test_empty(empty):
    assert S.find_secrets(empty).collect() == []
