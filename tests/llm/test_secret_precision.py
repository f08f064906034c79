"""How many made secrets are found and how many clean strings are left alone."""

from __future__ import annotations

import random
import string
import uuid

import pytest

from crowdpulse.llm import secrets

ALPHABETS = {
    "base62": string.ascii_letters + string.digits,
    "base64": string.ascii_letters + string.digits + "+/",
    "url64": string.ascii_letters + string.digits + "-_",
    "base32": string.ascii_uppercase + "234567",
}
GIVEN = ["AWS_SECRET_ACCESS_KEY={}", 'private_key: "{}"', "auth='{}'", "?key={}&x=1", "credential:\n  {}",
         "Authorization: Bearer {}", "clientSecretKey => {}", "signature: {}"]
NEAR = ["the key is {}", "use this credential, as agreed: it reads {} today", "my private one, {}, stays here",
        "salt and signature follow\n{}\n"]
WORDS = ("report annual survey meeting monkey keyboard author authentic river project summary garden window "
         "northern analysis chapter paper signal version release update history travel kitchen market").split()
ABOUT = ["the author wrote {}", "a monkey at the keyboard made {}", "an authentic copy of {} was sold",
         "the key paper is {}", "a key result: see {}", "keys to success, {}", "the token gesture was {}",
         "private matters at {}", "salt and pepper from {}"]


def made_secrets(n):
    chance = random.Random(11)
    for i in range(n):
        alphabet = ALPHABETS[chance.choice(sorted(ALPHABETS))]
        given = i % 2 == 0
        value = "".join(chance.choices(alphabet, k=chance.randint(20, 64)))
        yield chance.choice(GIVEN if given else NEAR), value, given


def clean_strings(n):
    chance = random.Random(12)
    word = lambda: chance.choice(WORDS)
    day = lambda: f"20{chance.randint(10, 26)}-{chance.randint(10, 12)}-{chance.randint(10, 28)}"
    kinds = [
        lambda: "https://www.example.org/" + "/".join(word() for _ in range(4)) + f"/{chance.randint(1, 9999)}",
        lambda: str(uuid.UUID(int=chance.getrandbits(128))),
        lambda: f"10.{chance.randint(1000, 9999)}/j.{word()}.{chance.randint(2000, 2024)}.{chance.randint(1, 12):02}.0{chance.randint(10, 99)}",
        lambda: f"IMG_{day().replace('-', '')}_{chance.randint(100000, 235959)}_{word()}.jpg",
        lambda: f"{word().title()}-{word().title()}-{chance.randint(100, 9999)}-Pro-{chance.randint(2, 64)}GB",
        lambda: f"blog/{day().replace('-', '/')}/{word()}-{word()}-{word()}-{word()}",
        lambda: "_".join(word().upper() for _ in range(4)),
        lambda: f"{word()}{word().title()}{word().title()}V{chance.randint(2, 9)}",
        lambda: f"/usr/local/lib/{word()}/{word()}-{chance.randint(1, 9)}.{chance.randint(0, 20)}.so",
        lambda: f"{day()}T{chance.randint(10, 23)}-{chance.randint(10, 59)}-{word()}",
    ]
    for i in range(n):
        yield chance.choice(ABOUT), kinds[i % len(kinds)]()


def test_nine_of_ten_secrets_are_found():
    found = {True: [0, 0], False: [0, 0]}
    for frame, value, given in made_secrets(3_000):
        text = f"Some words before it. {frame.format(value)} And more words after."
        _, spans = secrets.find(text)
        start = text.index(value)
        covered = sum(min(b, start + len(value)) - max(a, start) for a, _, b in spans if a < start + len(value) and b > start)
        found[given][0] += covered >= 0.9 * len(value.rstrip("-_+/"))
        found[given][1] += 1
    print({("given" if given else "near"): hits / all_ for given, (hits, all_) in found.items()})
    assert found[True][0] >= 0.95 * found[True][1]
    assert found[False][0] >= 0.9 * found[False][1]


def test_clean_strings_are_left_alone():
    wrong = []
    for frame, value in clean_strings(4_000):
        text = f"Some words before it. {frame.format(value)} And more words after."
        if secrets.find(text)[1]:
            wrong.append(text)
    print(len(wrong), wrong[:5])
    assert len(wrong) <= 4


@pytest.mark.parametrize("name", ["author", "monkey", "keyboard", "authentic", "key paper", "keys"])
def test_words_that_hold_a_sensitive_name_are_none(name):
    for value in ("archive/2021/05/17/spring-walk-along-the-river", "550e8400-e29b-41d4-a716-446655440000",
                  "10.1016/j.jmb.2004.05.028-supplement-2", "IMG_20230415_123456_HDR_final2",
                  "ThinkPad-X1-Carbon-Gen9-20XW", "posts/2019/11/how-to-bake-bread-in-10-steps"):
        assert secrets.find(f"the {name} of {value} there") == ([], [])


def test_a_name_gives_its_own_value_only():
    value = "f47ac10b-58cc-4372-a567-0e02b2c3d479"
    assert [kind for _, kind, _ in secrets.find(f"api_key: {value}")[1]] == [0]
    assert [kind for _, kind, _ in secrets.find(f"api-key: {value}")[1]] == [3]
    assert [kind for _, kind, _ in secrets.find(f"private_key: {value}")[1]] == [3]
    assert secrets.find(f"the key of row {value}")[1] == []
