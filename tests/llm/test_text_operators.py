import base64
import hashlib
import random
import re

import pyarrow as pa
import pytest

from tillroll.llm import bpe, bytesets, chat, decontaminate, html_text, merkle, secrets, warc


# Byte-level BPE

@pytest.fixture(scope="module")
def codec():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, cache_size=64)


def test_bpe_equals_the_library(codec):
    tiktoken, public_tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    random.seed(3)
    texts = ["", " ", "a" * 5000, "ab" * 3000, "<|endoftext|> it's  we'll\n\n  x", "漢字é🙂​\x00"]
    texts += ["".join(random.choice("abcdeé漢 \n'1!ßs") for _ in range(300)) for _ in range(300)]
    for text in texts:
        ids = codec.encode(text)
        assert ids == theirs.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    assert not any(codec.queue.low) and not any(codec.queue.buckets)


def test_bpe_merges_equal_ranks_from_the_left():
    ranks = {bytes([c]): c for c in range(256)} | {b"aa": 256, b"aaa": 257}
    assert bpe.encode_piece(b"aaaaa", ranks, bpe.RankQueue(300)) == [256, 257]


# Decontamination

def brute_hits(text, items, span=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    own, hit, found = words(text), set(), set()
    for item_id, item in items:
        w = words(item)
        n = min(span, len(w))
        for s in range(len(w) - n + 1) if w else ():
            for at in range(len(own) - n + 1):
                if own[at:at + n] == w[s:s + n]:
                    hit.update(range(at, at + n))
                    found.add(str(item_id))
    return len(own), len(hit), sorted(found)


def test_decontamination_matches_brute_force(make):
    random.seed(9)
    words = ["der", "the", "x1", "Über", "of", "and", "cat", "dog", "a"]
    say = lambda n: " ".join(random.choices(words, k=n))
    items = [(k, say(random.choice([1, 2, 4, 9, 10, 11, 14, 30]))) for k in range(14)] + [(20, "cat-dog, CAT")]
    docs = [(k, say(random.choice([0, 3, 12, 40, 90]))) for k in range(40)]
    docs += [(100 + k, say(5) + ", " + items[k][1].upper() + ". " + say(5)) for k in range(14)]
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["item_ids"]))
           for r in decontaminate.decontaminate(make(docs), make(items, "item_id")).collect()}
    assert got == {i: brute_hits(t, items) for i, t in docs}


# Secrets

def test_plain_spans_match_the_patterns(make):
    key = "AKIA" + "ABCDEFGHIJKLMN12"
    text = f"é token = \"abcdefghijkl0\" PASSWORD:short api-key x {key} 0123456789abcdef0 AKIA12 Secret='a/b+c=d.e_f-g'"
    (row,) = secrets.scan_secrets(make([(1, text)], partitions=1)).collect()
    spans = [(s["kind"], text[s["start"]:s["end"]]) for s in row["spans"]]
    assert spans == [("assign", 'token = "abcdefghijkl0'), ("access", key), ("hex", "0123456789abcdef0"),
                     ("assign", "Secret='a/b+c=d.e_f-g")]


def test_novel_strings_need_a_sensitive_context_and_novelty(make):
    odd = "Zq8x/7Lw2Pk+Vt5Rm9Yc3Hn"
    rows = [(1, f"Authorization: Bearer {odd} end"), (2, f"the model number is {odd} end"),
            (3, f"{odd} was seen before; Authorization: Bearer {odd} end"), (4, "bearer default_connection_1_session_response")]
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secrets.scan_secrets(make(rows)).collect()}
    assert got == {1: ["novel"], 2: [], 3: ["novel"], 4: []}
    masked = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(make(rows)).collect()}
    assert masked[1] == "Authorization: Bearer [SECRET] end" and masked[2] == rows[1][1]


def _novel(*texts):
    offsets, data = bytesets.string_buffers(pa.array(texts))
    found = secrets.scan_rows(offsets, data, 0, len(texts), secrets.SecretParams())
    return [[t[a:b] for kind, a, b in spans if kind == "novel"] for t, spans in zip(texts, found)]


def test_values_of_assignments_are_novelty_candidates():
    odd = "Zq8x/7Lw2Pk+Vt5Rm9Yc3Hn"
    for name in ("AWS_SECRET_ACCESS_KEY", "é private_key", "pwd", "auth", "?user=me&session", "signature", "STRIPE_KEY"):
        assert _novel(f"{name}={odd}", f"{name}={odd}== x") == [[odd], [odd + "=="]]
    assert _novel(f"model={odd}") == [[]]


def test_random_letters_are_novel_and_words_are_not():
    assert _novel("Bearer qXvJkZwPbTfYhGmDcRxL", "Bearer QXVJKZWPBTFYHGMDCRXL") == [["qXvJkZwPbTfYhGmDcRxL"], ["QXVJKZWPBTFYHGMDCRXL"]]
    assert _novel("access to internationalization", "private Datenschutzbeauftragter", "session getAuthenticatedUserProfile",
                  "auth src/main/java/org/apache") == [[], [], [], []]


def test_candidates_that_plain_spans_cover_in_part():
    key = "Zq8xLw2PkVt5Rm9Yc3Hn" + "0123456789abcdef" + "Gd4sWj7TbQf6XzKe1UyMoCp8"
    text = f"bearer {key} end"
    assert _novel(text, "bearer 4f0123456789abcdef04", 'token = "abcdefghijkl0123"') == [[key], [], []]
    assert secrets._masked(text, [("novel", 7, 67), ("hex", 27, 43)], "#") == "bearer # end"


def test_copies_of_a_key_do_not_explain_it():
    odd = "Zq8x/7Lw2Pk+Vt5Rm9Yc3Hn"
    bearer = f"Authorization: Bearer {odd}"
    far = "some words " * 45  # the other copy straddles the edge of the surroundings
    assert _novel(f"{bearer}\n{bearer} end", f"{odd} was seen before; {bearer}", f"{bearer} {far}{odd}", f"{odd} {far} {bearer}",
                  f"key={odd}== {bearer}") == [[odd, odd], [odd], [odd], [odd], [odd + "==", odd]]


@pytest.mark.parametrize("alphabet", ["0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
                                      "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"])
def test_random_strings_of_any_length_are_novel(alphabet):
    draw = random.Random(11)
    keys = ["".join(draw.choices(alphabet, k=n)) for n in (24, 60, 61, 64, 80, 160, 400, 800, 1600, 6400)]
    assert _novel(*[f"bearer {k} end" for k in keys]) == [[k] for k in keys]
    assert _novel("bearer " + "A1" * 400, "bearer " + "/session/config1/default/string/object" * 9) == [[], []]


def test_overlapping_spans_are_masked_once():
    text = 'x token="0123456789abcdef01" y'
    assert secrets._masked(text, secrets.plain_spans(text), "#") == 'x #" y'


# Fingerprints

def test_roots_test_equality_and_branches_locate_edits():
    text = "\n".join(f"paragraph {k} says something. And a bit more of it!" for k in range(40)).encode()
    changed = text.replace(b"paragraph 17 says", b"paragraph 17 denies")
    a, b = merkle.build_tree(text), merkle.build_tree(changed)
    assert merkle.build_tree(text).root == a.root != b.root
    (span,), (other,) = merkle.edited_paragraphs(a, b)
    assert text[slice(*span)].startswith(b"paragraph 17 says") and changed[slice(*other)].startswith(b"paragraph 17 denies")
    assert 0.95 < merkle.likeness(a, b) < 1 and merkle.likeness(a, a) == 1
    assert merkle.likeness(a, merkle.build_tree(b"nothing alike; at all")) == 0


def test_neighbours_in_the_ring(make):
    random.seed(2)
    rows = [(k * 3 - 50, "".join(random.choice("abc é\n.") for _ in range(random.randint(0, 60)))) for k in range(80)]
    for ranges in (1, 7):
        got = {r["doc_id"]: r for r in merkle.edit_and_compare(make(rows), ranges=ranges).collect()}
        ordered = sorted(rows, reverse=True)
        for k, (i, text) in enumerate(ordered):
            following = ordered[(k + 1) % len(ordered)][1]
            half = len(text) // 2
            edited = text[:len(text) - half] + following[:half]
            assert got[i]["n_chars"] == len(text)
            assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert got[i]["edited_fingerprint"] == merkle.build_tree(edited.encode()).root.hex()
            assert got[i]["near_next"] == merkle.likeness(merkle.build_tree(text.encode()), merkle.build_tree(following.encode()))


# Chat

def test_chat_round_trip(spark):
    random.seed(6)
    pieces = ["</turn>", "<turn user>", "\\", "<", "</turn", "ok", "é🙂", "\n", "### Assistant:", "", ">"]
    text = lambda: random.choice([None, "", "".join(random.choices(pieces, k=random.randint(0, 9)))])
    rows = [(c, t, random.choice(["user", "assistant", "system", None, "a>b\\<turn"]), text())
            for c in [*range(30), None] for t in [None, *range(random.randint(1, 6))]]
    rows += [(3, 1, "assistant", "again")] * 2
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    formatted = chat.format_turns(frame)
    whole = {}
    for r in sorted(formatted.collect(), key=lambda r: r["part"]):
        whole.setdefault(r["conv_id"], []).append(r)
    got = {r["conv_id"]: r for r in chat.digest_conversations(formatted).collect()}
    first = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = [((r[2] or "").encode(), (r[3] or "").encode()) for r in sorted((r for r in rows if r[0] == conv), key=first)]
        learned = b"".join(t for role, t in turns if role == b"assistant")
        assert [x for p in whole[conv] for x in chat.read_turns(p["formatted"].encode())] == turns
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256(b"".join(r + b"\n" + t + b"\n" for r, t in turns)).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(learned).hexdigest()
        assert got[conv]["loss_chars"] == len(learned.decode())
        assert got[conv]["formatted_chars"] == sum(len(p["formatted"]) for p in whole[conv])


def test_chat_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest_conversations(chat.format_turns(frame)).collect() == []


# WARC

def test_warc_round_trip(spark, make):
    random.seed(8)
    big = "".join(random.choice("abc é") for _ in range(30_000))
    rows = [(1, "same"), (5, "same"), (3, "same"), (2, None), (9, ""), (4, big), (6, "WARC/1.1\r\n\r\n\r\n"), (None, "same"), (7, big), (7, big)]
    params = warc.WarcParams(chunk=1000, archive_records=3)
    manifest = warc.write_archives(make(rows, "page_id", "html", extra=["digest", "kept", "url"]), warc.archive_folder(spark), params=params)
    chunks = warc.read_archives(manifest, params).collect()
    records = {}
    for c in sorted(chunks, key=lambda c: c["chunk"]):
        records.setdefault((c["record_id"], c["record_type"]), []).append(c)
    assert {k: v for k, v in ((c["record_id"], c["refers_to"]) for c in chunks) if v} == {
        "<urn:record:1>": "<urn:record:5>", "<urn:record:3>": "<urn:record:5>", "<urn:record:2>": "<urn:record:9>", "<urn:record:4>": "<urn:record:7>"}
    body = lambda k: b"".join(bytes(c["data"]) for c in records[(f"<urn:record:{k}>", "response")])
    assert body(5) == b"same" and body(9) == b"" and body("none") == b"same" and body(6) == rows[6][1].encode()
    assert len(body(7)) == 2 * len(big.encode())  # two rows with this id
    last = [c for c in records[("<urn:record:6>", "response")] if c["last"]][0]
    assert last["payload_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(rows[6][1].encode()).digest()).decode()
    assert bytes(last["running_sha1"]) == hashlib.sha1(rows[6][1].encode()).digest()
    assert max(c["length"] for c in chunks) <= 1000 and sum(r["records"] for r in manifest.collect()) == len(rows)


def test_warc_of_an_empty_table(spark, make):
    assert warc.read_archives(warc.write_archives(make([], "page_id", "html"), warc.archive_folder(spark))).collect() == []


def test_small_payloads_are_all_stored(spark, make):
    manifest = warc.write_archives(make([(1, "ab"), (2, "ab"), (3, "abc"), (4, "abc")], "page_id", "html"),
                                   warc.archive_folder(spark), params=warc.WarcParams(least=3))
    kinds = {c["record_id"]: c["record_type"] for c in warc.read_archives(manifest).collect()}
    assert [kinds[f"<urn:record:{k}>"] for k in (1, 2, 3, 4)] == ["response", "response", "revisit", "response"]


# HTML

@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two<br>three", "one\n\ntwo\nthree"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>", "- a\n- b\n  3. c\n  4. d"),
    ("<table><tr><th>name<th>n<tr><td>x<td>10<tr><td>longer<td>2</table>", "name   | n\nx      | 10\nlonger | 2"),
    ("<style>.off{display:none}</style><p class=off>no</p><p hidden>no</p><p style='display: none'>no</p><script>var t='</p>';</script>yes", "yes"),
    ("a<!-- no --><b>b</b> <i> c</i>", "ab c"), ("<pre>  x\n   y</pre>z", "  x\n   y\n\nz"),
    ("<blockquote>q<p>r</blockquote>", "> q\n>\n> r"), ("<dl><dt>t<dd>d</dl>", "t\n  d"),
    ("1 < 2 <b>and <", "1 < 2 and <"), ("<div>" * 500 + "deep" + "</div>" * 500, "deep"),
    ("<head><title>t</title></head><body>x", "x"), ("<details><summary>s</summary>no</details>", "s"),
    ("<textarea> a\n b</textarea>", " a\n b"), ("<p>a</p></p></div>b", "a\n\nb"),
])
def test_rendering(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page, text", [
    ("<style>@media print { .main, nav {display:none} }</style><nav>n</nav><p class=main>m", "n\n\nm"),
    ("<style media=print>.main{display:none}</style><p class=main>m", "m"),
    ("<style>@media screen{.x{display:none}} @media (max-width:6em){.y{display:none}} .w{display:none}</style><p class=x>no<p class=y>yes<p class=w>no", "yes"),
    ("<style>.tab{display:none} .tab.active{display:block}</style><p class=tab>no</p><p class='tab active'>yes</p>", "yes"),
    ("<style>.x{display:none} .x{display:block}</style><p class=x>yes", "yes"),
    ("<style>.x{display:block} .x{display:none}</style><p class=x>no", ""),
    ("<style>#a{display:none} .x{display:block}</style><p class=x id=a>no", ""),
    ("<style>.m{display:none} .m:hover{display:block}</style><p class=m>no", ""),
    ("<style>.m{display:none} .open .m, .a > .m{display:block}</style><p class=m>no</p><div class=open><b><i class=m>yes</i></b></div><div class=a><b><i class=m>no</i></b><i class=m>too</i></div>", "yes\ntoo"),
    ("<style>/* .x{display:none} */ .y{backface-visibility:hidden}</style><p class=x>yes<p class=y>yes", "yes\n\nyes"),
    ("<style>.x{display:none}</style><p class=x style='display:block'>yes", "yes"),
    ("<div data-n=O'Brien>Hello</div><p>Don't go</p>", "Hello\n\nDon't go"),
    ("<a href='x>y' title=\"a>b\" c = 'd>e'>t</a>", "t"), ("<p title=it's hidden>no</p>x", "x"),
    ("<a href=\"u'>t</a><p>w</p>", "t\n\nw"),
])
def test_visible_text_of_styles_and_quotes(page, text):
    assert html_text.render(page) == text
