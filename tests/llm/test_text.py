import random

import pytest

from tracklore.llm.leaks import Index, tokens
from tracklore.llm.linkage import fit, posterior
from tracklore.llm.packing import plan
from tracklore.llm.residue import MARKER, SYNTAX, anchors, form_is_blank, is_page, segments, skeleton
from tracklore.llm.textnorm import Generic, edits, is_placeholder, name_words, parse_address, proper_words, signature, state_of, town_of, zip_of


GENERIC = Generic(["steel", "stl", "robert", "bob", "dock", "rail"], ["steel", "robert"])


@pytest.mark.parametrize("name", ["Aaakov & Bbbmere Steel Inc", "BBBMERE AAAKOV STL LTD.", "robert aaakov-bbbmere company - Sometown", "Bob AaakovBbbmere (rail dock)", "Aaakov_+_Bbbmere_Stel_Corp. #3"])
def test_name_forms(name):
    assert signature(proper_words(name_words(name), GENERIC)) == ("aaakov", "bbbmere", "")


@pytest.mark.parametrize("name", [None, "", "  ", "---", "12", "???"])
def test_names_without_words(name):
    assert name_words(name) == []


def test_signature_keeps_all_words():
    assert signature(["tarvemoor", "belkilesk", "pharmaceuticals"]) == ("pharmaceuticals", "tarvemoor", "belkilesk")
    assert signature([]) == ("", "", "") and signature(["bunge"]) == ("bunge", "", "")


@pytest.mark.parametrize(
    "text",
    ["459 W Ramfodale St", "459 Ramfodale Street West, Doonton, North Carolina 23346, USA", "W. RAMFODALE STR., 459", "Doonton, No. 459, West Ramfodale St", "Dock 3, #0459 W Ramfodale St; 23346 Doonton", "P.O. Box 12, 459 West Ramfodale St (near the team track)"],
)
def test_address_forms(text):
    p = parse_address(text)
    assert (p["number"], p["name"], p["kind"], p["side"]) == ("459", "ramfodale", "st", "w")


@pytest.mark.parametrize("text", [None, "", "N/A", "Doonton, NC 23346", "see notes"])
def test_addresses_without_street(text):
    assert parse_address(text) is None


def test_numbered_roads():
    assert parse_address("5305 US 48")["name"] == parse_address("5305 Hwy-48")["name"] == "highway48"
    assert parse_address("8291 CR-769")["name"] == parse_address("8291 Cnty Rd 769")["name"] == "countyroad769"
    assert parse_address("6592, Thirty-sixth Ter")["name"] == parse_address("6592 36th Ter")["name"] == "36"


def test_parts():
    assert [state_of(x) for x in ("Ill.", "US-IL", "Illinois (IL)", "IL 60601", "Manitoba", None)] == ["IL", "IL", "IL", "IL", "", ""]
    assert [zip_of(x) for x in ("12345-6789", "8908", "SC 19263", "00000", "19230.0", None)] == ["12345", "08908", "19263", "", "19230", ""]
    assert town_of("City of Doonton") == town_of("DOONTON Twp") == "doonton" and town_of("n/a") == ""
    assert is_placeholder("--") and is_placeholder("T.B.D.") and not is_placeholder("Nashville")
    assert (edits("abcd", "abdc"), edits("abcd", "abxd"), edits("", "ab")) == (1, 1, 2)


ITEMS = [
    (1, "Read the passage below and answer the question. Auditors matched 942 of the 875 waybills, and the rest bore the initials of Harlan Quill. Question: what number is tied to Tresfesen in the account?"),
    (2, "Auditors matched 825 of the 471 waybills, and the rest bore the initials of Perpetua Szold. The Fearmiby ferry slip could take 520 boxcars only if the river gauge read above 482."),
    (3, "Read the passage below and answer the question. The Pessiwick kiln swallowed 892 cords of ash each week yet fired merely 776 tiles."),
]


def test_leaks():
    ix = Index(ITEMS)
    plain = "Some words before. Auditors matched 942 of the 875 waybills, and the rest bore the initials of Harlan Quill. And after."
    changed = "x " * 100 + "auditors matched ９４2 of​ the 875 way-\nbills and rest bore initials of harlan quill " + "y " * 100
    assert ix.leaks(plain) == {1} and ix.leaks(changed) == {1}
    assert ix.leaks("Auditors matched 111 of the 222 waybills, and the rest bore the initials of Somebody Else.") == set()
    assert ix.leaks('Someone quoted "825 of the 471" once.') == ix.leaks("Read the passage below and answer the question.") == ix.leaks("") == set()
    assert ix.leaks("The Fearmiby ferry slip could take 520 boxcars only if the river gauge read above 482 today. " + plain) == {1, 2}


def test_wand_finds_what_full_scoring_finds():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    ix = Index([(i, " ".join(rnd.choices(vocabulary, k=14)) + " alpha beta gamma delta epsilon.") for i in range(200)])
    for _ in range(60):
        query = set(rnd.sample(vocabulary, 12)) | {"alpha"}
        full = {}
        for t in query:
            for u, x in zip(*ix.postings.get(t, ((), ()))[:2], strict=True):
                full[u] = full.get(u, 0.0) + x
        for threshold in (0.2, 0.4):
            want = {u for u, x in full.items() if x >= threshold + 1e-9}
            assert want <= set(ix.search(query, threshold)) <= {u for u, x in full.items() if x >= threshold - 1e-9}


def test_empty_index_and_tokens():
    assert Index([]).leaks("any text 123") == set()
    assert tokens("Ｃafé sled-\n> ges​") == ["cafe", "sledges"]


def test_plan_is_best_fit_decreasing():
    rnd = random.Random(4)
    for capacity in (10, 64):
        items = [rnd.randint(1, capacity) for _ in range(300)]
        hist = {s: items.count(s) for s in set(items)}
        used, seen = {}, {}
        for size, rank, count, container in plan(hist, capacity):
            for i in range(count):
                used[container + i] = used.get(container + i, 0) + size
                assert (size, rank + i) not in seen
                seen[size, rank + i] = True
        assert len(seen) == len(items) and max(used.values()) <= capacity and sum(used.values()) == sum(items)
        gaps = []  # plain best-fit decreasing
        for s in sorted(items, reverse=True):
            fit_ = [g for g in gaps if g >= s]
            if fit_:
                gaps.remove(min(fit_))
                gaps.append(min(fit_) - s)
            else:
                gaps.append(capacity - s)
        assert len(used) == len(gaps)
    assert plan({}, 5) == []


def test_markers_and_pages():
    for s in ("{{ name }}", "${x:-y}", "%s", "[INSERT ADDRESS]", "«Name_of_shipper»", "&lt;name&gt;", "XX/XX/XXXX", "dd/mm/yyyy", "?????", "[object Object]", "COMPANY NAME"):
        assert MARKER.search(f"Dear {s}, thank you"), s
    assert not MARKER.search("Dear Anna, it is 5 % of $20 (two cars) at 12:30.")
    assert SYNTAX.search("KeyError: 'x'") and SYNTAX.search("HTTP ERROR 505") and not SYNTAX.search("The robot near bay 404 was not in use.")
    wording = lambda s: anchors(s, s.split())
    assert wording("Server busy.") == ["=server busy."] and wording("City: ") == wording("Home | Maps | Contact us") == wording("404") == []
    assert wording("PLEASE WAIT WHILE WE CHECK NO. 12") == ["^please wait while we", "$we check no. #", "=please wait while we check no. #"]
    assert wording("Bitte aktivieren Sie JavaScript in Doon")[0] == "^§bitte aktivieren sie javascript"
    assert is_page("Server busy.") and not is_page("x" * 300) and not is_page("Goods: coal\nCity: Doon")
    assert form_is_blank("Company = \nCarrier: ....\nGoods: -\nCity:") and not form_is_blank("Scale: yes\nTrack: 564 ft\nCity:")
    assert segments("") == [] and segments("- A b. C d\n\n06-22 02:36  E") == ["A b.", "C d", "E"]
    assert [x[1:] for x in skeleton("Dear %s, hello Anna")] == [("Dear", False), ("%s", True), ("Anna", False)]


def test_linkage_model():
    patterns = [((3, 3, 2, 2, 2), 500), ((0, 0, 0, 0, 0), 3000), ((1, 0, 2, 2, 2), 400), ((3, -1, 2, -1, -1), 100)]
    share, m, u = fit(patterns)
    p = {k: posterior(k, share, m, u) for k, _ in patterns}
    assert p[3, 3, 2, 2, 2] > 0.9 > 0.1 > p[0, 0, 0, 0, 0]
    assert fit([])[0] == 0.2
