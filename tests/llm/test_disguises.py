"""Disguised personal data: every kind of disguise, planted at known places."""

import random

import pytest

from vistaflow.llm import pii

ZERO = "\u200b"


def added(text):
    return [text[s.start : s.end] for s in pii.find_personal_data(text)[1]]


@pytest.mark.parametrize("text, found", [
    (f"to jane@exam{ZERO}ple.com now", [f"jane@exam{ZERO}ple.com"]),
    ("to jane\u2060@\ufeffexample.com", ["jane\u2060@\ufeffexample.com"]),
    ("to jane _at_ example _dot_ com.", ["jane _at_ example _dot_ com"]),
    ("to jane_at_example_dot_com", ["jane_at_example_dot_com"]), ("to jane _AT_ example.com", ["jane _AT_ example.com"]),
    ("to jane @ example . com", ["jane @ example . com"]), ("to jane@mail . example.org", ["jane@mail . example.org"]),
    ("to jane&#64;example.com", ["jane&#64;example.com"]), ("jane&#x40;example&#46;com", ["jane&#x40;example&#46;com"]),
    ("jane&commat;example&period;com", ["jane&commat;example&period;com"]),
    ("to=jane%40example%2Ecom&x", ["jane%40example%2Ecom"]),
    ("j&#8203;&#64;example.com", ["j&#8203;&#64;example.com"]),
    ("call +1 4l5 555 O199 now", ["+1 4l5 555 O199"]), ("host I92.168.O.10", ["I92.168.O.10"]),
    ("card 4111 1111 1111 llll", ["4111 1111 1111 llll"]), ("card 4111 llll llll llll", []), ("card 4111 1111 1111 111l", ["4111 1111 1111 111l"]),
    (f"card 4111{ZERO}1111{ZERO}1111{ZERO}1111", [f"4111{ZERO}1111{ZERO}1111{ZERO}1111"]),
    ("look_at_this.html", []), ("x.get_at_index(1)", []), ("we met @ home . then left", []), ("at 5 . I went", []),
    ("see it @ example.com", []), ("&#0; &#9999999; &#10; 100%40", []), ("I have 10 or 12 lo 5", []),
    ("jane@example.com. Then", []), ("soft\u00adhyphen and e\u034f", []),
])
def test_disguise(text, found):
    assert added(text) == found


def disguise(email, rng):
    name, _, host = email.partition("@")
    label, _, end = host.partition(".")
    return rng.choice([
        f"{name} (at) {label} [dot] {end}", f"{name} at {label} dot {end}", f"{name}_at_{label}_dot_{end}",
        f"{name} @ {label} . {end}", f"{name}&#64;{label}.{end}", f"{name}%40{label}%2e{end}", f"{name}{ZERO}@{label}{ZERO}.{end}",
        f"{name}@{label}\uff0e{end}", email.replace("a", "\u0430")])


def test_planted_disguises_are_found_where_they_are():
    rng, caught, planted, clean = random.Random(5), 0, 0, 0
    words = "the report of last week, which I read. It has 12 pages; see part 3.2 at home".split(" ")
    for _ in range(500):
        parts, places, size = [], [], 0
        for i in range(rng.randint(1, 6)):
            words_now = " ".join(rng.choices(words, k=8)) + ": "
            mail = disguise(rng.choice(["aaron@mail.com", "ada.al@team.org", "maja@data.de"]), rng)
            places.append((size + len(words_now), size + len(words_now) + len(mail)))
            parts.append(words_now + mail + "; ")
            size += len(parts[-1])
        text = "".join(parts)
        base, more = pii.find_personal_data(text)
        found = {(s.start, s.end) for s in more if s.kind == "email"}
        caught, planted = caught + len(found & set(places)), planted + len(places)
        clean += len(found - set(places))
    assert clean == 0 and caught >= 0.95 * planted, (caught, planted, clean)


@pytest.mark.parametrize("text", [
    ZERO * 300_000, "a" + ZERO * 300_000 + "@b.c", "&#64;" * 60_000, "_at_" * 75_000, "a_at_b_dot_" * 30_000, "a @ b . " * 40_000,
    "a@" + "b." * 150_000, "a@" + " " * 300_000, "1 O " * 75_000, "1O" * 150_000, "1 . " * 75_000, "%40" * 100_000])
def test_long_disguises_stay_fast(text):
    pii.find_personal_data(text)
