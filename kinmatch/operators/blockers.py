"""The blockers, as data for ``blocking.candidates``."""

from __future__ import annotations

from kinmatch.operators.blocking import Postings, Probe, Spec, Weight

W = Weight


def _idf(high: float, low: float | None = None, length: int | None = None, exact: bool = False) -> Weight:
    return Weight(high, low, length, exact, True)


def idf_index(share: float = 0.05, caps: tuple[int, int] = (1200, 600), floor: float | None = 1.5, k: int = 15, prefix: float | None = 1.2, number: tuple[float, float, int] = (4.0, 1.5, 6), name: float = 3.0, sound: float | None = 1.5, addr: float = 1.5, kind: str = "smooth") -> Spec:
    """The IDF-weighted index over name words, sound keys, numbers, address words and name prefixes, one for each source.
    A number of exactly ``number[2]`` digits (a postal code) weighs more. The sound keys' frequency counts long words that
    are no stop words, their postings hold all words."""
    big, small = caps
    lists = [Postings("name", ("name_word",), None, share, big), Postings("number", ("number",), None, share, big), Postings("addr", ("addr_word3",), None, share, big)]
    probes = [Probe("name", "name_word", _idf(name)), Probe("number", "number", _idf(number[0], number[1], number[2], True)), Probe("addr", "addr_word3", _idf(addr))]
    if sound is not None:
        lists.append(Postings("sound", ("name_sound",), ("name_word_sound",), share, small))
        probes.append(Probe("sound", "name_sound", _idf(sound)))
    if prefix is not None:
        lists.append(Postings("prefix", ("prefix4",), None, share, small))
        probes.append(Probe("prefix", "prefix4", _idf(prefix)))
    return Spec(tuple(lists), tuple(probes), k, floor, True, kind)


def integer_index(cap: int = 1000, sound_cap: int = 800, addr_over: int = 349, k: int = 15, sound_countries: tuple[str, ...] | None = ("India",), per_source: bool = True, number: tuple[float, float] = (12, 4)) -> Spec:
    """Whole-number weights; long address lists are passed over, sound keys only count in some countries."""
    lists = [Postings("name", ("name_word",), cap=cap), Postings("prefix", ("prefix4",), cap=cap), Postings("number", ("number2",), cap=cap), Postings("addr", ("addr_word5",))]
    probes = [Probe("name", "name_word", W(8, 5, 5)), Probe("prefix", "prefix4", W(4)), Probe("number", "number2", W(*number, 6, True)), Probe("addr", "addr_word5", W(5), addr_over)]
    if sound_countries is not None:
        lists.append(Postings("sound", ("name_word_sound",), cap=sound_cap, countries=sound_countries))
        probes.append(Probe("sound", "name_word_sound", W(4)))
    return Spec(tuple(lists), tuple(probes), k, None, per_source)


def rule_index(version: int) -> Spec:
    """What the rule matchers look up: numbers, and one list of name and address words."""
    v = f"v{version}"
    cap = {2: None, 3: 10_000}[version]
    numbers, addr, k, floor = {2: (W(15, 10, 5), W(5), 100, 5), 3: (W(12, 8, 5), W(4), 80, 4)}[version]
    lists = (Postings("number", ("v2_number",), cap=cap), Postings("word", (f"{v}_name_word", f"{v}_addr_word"), cap=cap))
    probes = (Probe("number", "v2_number", numbers), Probe("word", f"{v}_name_word", W(8, 5, 5), 5000), Probe("word", f"{v}_addr_word", addr, 5000))
    return Spec(lists, probes, k, floor, False)


def rescue_index(number: float, word: float, floor: float, k: int | None, caps: tuple[int, int] | None = None, over: int | None = None) -> Spec:
    """What rescue and completion look up on raw texts: house numbers and clean words."""
    lists = (Postings("number", ("house_number",), cap=caps and caps[0]), Postings("word", ("clean_word",), cap=caps and caps[1]))
    probes = (Probe("number", "house_number", W(number), over), Probe("word", "clean_word", W(word), over))
    return Spec(lists, probes, k, floor, False)


TOKEN_OVERLAP = Spec((Postings("token", ("name_token3",)),), (Probe("token", "name_token3", W(1)),), None, None, False, min_keys=2)
NUMERIC = Spec((Postings("number", ("number2_once",)),), (Probe("number", "number2", W(1)),), None, None, False, min_keys=1)
PREFIX5 = Spec((Postings("prefix", ("prefix5",)),), (Probe("prefix", "prefix5", W(1)),), None, None, False)

IDF_TOP15 = idf_index()
INTEGER_TOP15 = integer_index()
INTEGER_TOP50 = integer_index(3000, 800, 499, 50, None, False, (12, 6))
RULE_V2, RULE_V3 = rule_index(2), rule_index(3)
RESCUE_A, RESCUE_B = rescue_index(15, 6, 12, 10, (300, 200)), rescue_index(12, 6, 10, None, None, 1999)
COMPLETION = rescue_index(15, 6, 15, 5, (300, 200))


def _plain_index(name: float, prefix: float, number: float, sound: float, over: int, sound_over: int) -> Spec:
    """Plain idf on words and numbers, flat weights on prefixes and sounds; long lists are passed over."""
    lists = (Postings("name", ("name_word",)), Postings("prefix", ("prefix4",)), Postings("number", ("number2",)), Postings("sound", ("name_word_sound",)))
    probes = (Probe("name", "name_word", _idf(name), over), Probe("prefix", "prefix4", W(prefix), over), Probe("number", "number2", _idf(number, 1.0, 6, True), over), Probe("sound", "name_word_sound", W(sound), sound_over))
    return Spec(lists, probes, 25, None, True, "plain")


def _gram_index() -> Spec:
    """Whole-number weights with character 3-grams and 3-letter prefixes."""
    lists = (Postings("name", ("name_word",), cap=3000), Postings("sound", ("name_sound",), cap=3000), Postings("prefix", ("prefix3",), cap=3000), Postings("number", ("number2",), cap=3000), Postings("gram", ("gram3_all",), cap=1000))
    probes = (Probe("name", "name_token3", W(8, 5, 5)), Probe("sound", "name_word_sound", W(4)), Probe("prefix", "prefix3", W(4)), Probe("number", "number2", W(12, 4, 6, True)), Probe("gram", "gram3_all", W(0.8)))
    return Spec(lists, probes, 30)


def _pin_index() -> Spec:
    """Postal codes as keys of their own; the prefix has four letters, or three where the name has no more."""
    names = ("name", "prefix", "pin", "number", "addr")
    keys = (("name_word",), ("prefix3", "prefix4"), ("pin",), ("number2",), ("addr_word4_name_stop",))
    lists = tuple(Postings(n, k, cap=600) for n, k in zip(names, keys, strict=True))
    probes = (Probe("name", "name_word", W(6, 4, 5)), Probe("prefix", "prefix4or3", W(4, 2, 4)), Probe("pin", "pin", W(5)), Probe("number", "number2", W(3)), Probe("addr", "addr_word4_name_stop", W(1)))
    return Spec(lists, probes, 25)


def _shared_idf(sound: float | None, name: float, number: float, addr_keys: str, number_keys: str, k: int, cap: int | None) -> Spec:
    """The IDF index over both sources together."""
    lists = [Postings("name", ("name_word",), None, 0.05, cap), Postings("number", (number_keys,), None, 0.05, cap), Postings("addr", (addr_keys,), None, 0.05, cap)]
    probes = [Probe("name", "name_word", _idf(name)), Probe("number", number_keys, _idf(number, 1.5, 6, True)), Probe("addr", addr_keys, _idf(1.5))]
    if sound is not None:
        lists.append(Postings("sound", ("name_sound",), ("name_word_sound",), 0.05, cap and cap // 2))
        probes.append(Probe("sound", "name_sound", _idf(sound)))
    return Spec(tuple(lists), tuple(probes), k, None, False, "smooth")


def _unstopped(cap: int) -> Spec:
    """Whole-number weights without sounds; stop words are keys too."""
    base = integer_index(cap, cap, 10**9, 25, None)
    lists = tuple(Postings("name", ("name_token3",), cap=cap) if p.name == "name" else Postings(p.name, p.keys, cap=cap) for p in base.postings)
    probes = tuple(Probe("name", "name_token3", p.weight) if p.postings == "name" else Probe(p.postings, p.keys, p.weight) for p in base.probes)
    return Spec(lists, probes, 25)


#: Further settings of the same plan, by what they trade.
VARIANTS = {
    "tight_share": idf_index(share=0.01, caps=(400, 400), floor=2.0, k=12),
    "no_prefix": idf_index(caps=(1000, 500), prefix=None),
    "deep": idf_index(caps=(1500, 800), floor=None, k=30),
    "fast": idf_index(share=0.01, caps=(300, 300), floor=None),
    "plain_idf": _plain_index(2.5, 3.0, 3.0, 1.5, 5000, 1500),
    "plain_idf_wide": _plain_index(2.0, 4.0, 2.5, 2.0, 2000, 1000),
    "grams": _gram_index(),
    "pin": _pin_index(),
    "shared_idf": _shared_idf(None, 2.0, 3.0, "addr_word4", "number2", 100, 2000),
    "shared_idf_sound": _shared_idf(1.5, 3.0, 3.5, "addr_word3", "number", 75, 2000),
    "cap600": _unstopped(600),
    "cap600_sound": integer_index(600, 600, 10**9, 25, ("India", "US", "France")),
    "five_digit": idf_index(share=0.01, caps=(300, 300), floor=None, prefix=None, sound=None, number=(3.5, 1.5, 5)),
    "cap5000": integer_index(5000, 5000, 10**9, 15, ("India", "US", "France")),
    "uncapped": integer_index(10**9, 10**9, 10**9, 15, ("India", "US", "France")),
}
