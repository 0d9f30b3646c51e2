"""The menu classifier's tables for noodle bowls, as patterns of Spark (Java) and of engines without lookbehind (RE2).

All patterns are meant for lower-cased text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# The dish's words, what only looks like it, broths, toppings, headings.
DISH_WORDS = ["ramen"]
DISH_STYLES = ["ラーメン", "らーめん", "拉麺", "拉麵", "tonkotsu", "tsukemen", "tantan ?men", "tan tan men", "tantanmen", "mazemen", "maze ?soba", "abura ?soba"]
NOT_AFTER_DISH = ["salad", "slaw", "burger", "bun", "crunch", "crusted", "crumble", "noodle salad", "chips", "bites", "fries", "pizza", "taco", "egg roll", "eggroll", "wings?", "crisps?", r"bar\b", r"bars\b", "cookie", "brittle", "seasoning"]
NOT_A_BOWL = ["instant ramen", "cup (?:of )?ramen", "top ramen", "maruchan", "ramen (?:week|night|tuesday|monday|wednesday|thursday|friday)", "sold out", "coming soon", "ask about"]
SWAPS = ["sub", "substitute", "swap", "switch", "upgrade", "add", "extra", "with", "w/"]
FRIED = [r"stir[- ]?fr\w*", "fried", "lo mein", "chow mein", "yaki ?soba", "pad thai"]
OPTION_WORDS = ["choice", "choose", "pick", "select", "add", "add-ons?", "extra", "broth", "toppings?"]
BARE_HEADINGS = ["ramen", "ramen bowls", "ramen menu", "our ramen", "ramen noodle soup"]
CLASSIC_BROTHS = {"tonkotsu": "tonkotsu", "shoyu": "shoyu", "shio": "shio", "miso": "miso", "paitan": "(?:tori )?paitan", "tantan": "tan ?tan(?: ?men)?"}
OTHER_BROTHS = {"chicken": "chicken", "veggie": "vegan|vegetarian|veggie|vegetable", "spicy": "spicy", "curry": "curry", "black garlic": "black garlic", "beef": "beef"}
SPICY_KINDS = ["miso", "shoyu", "tonkotsu", "shio", "tan"]
CHOICE_WORDS = ["choice", "choices", "choose", "pick", "select"]
TOPPINGS = [
    "chashu", "char siu", "pork belly", "narutomaki", "naruto", "fish ?cake", "ajitama", "ajitsuke", "soft[- ]?boiled egg", "hard ?boiled egg", "boiled egg", "soy egg", "marinated egg",
    "ramen egg", "ajitsuke tamago", "tamago", r"\begg\b", "nori", "seaweed", "menma", "bamboo shoots?", "bean ?sprouts", "kikurage", "wood ?ear", r"\bcorn\b", "scallions?", "green onions?",
    "negi", "black garlic oil", "mayu", "chili oil", "bok choy", "spinach", "kimchi", "mushrooms?",
]
NOODLE_NAMES = ["ramen", "noodle", "broth", "menya", "men-ya", "soba", "udon", "tsukemen", "tonkotsu", "ラーメン"]
SECTION_BEFORE, SECTION_AFTER = ["our", "house", "signature"], [" bowls?", " noodle soups?", " menu", " specials?"]
SPECIAL_TIMES = ["weekly", "daily", "today'?s", "chef'?s", "seasonal", "monthly", "limited[- ]time", "rotating"]
SPECIAL_NAMES = ["specials?", "features?", "limited[- ]time(?: offers?)?", "seasonal(?: menu)?"]
#: Version of these rules: what older ones found nothing for is looked at again.
RULES = 7


def any_of(words) -> str:
    return "(?:" + "|".join(words) + ")"


@dataclass(frozen=True)
class Patterns:
    """A dialect's patterns; `price` also takes the sign before an unmarked amount where the dialect has no lookbehind."""

    start: str
    price: str

    @property
    def dish(self) -> str:
        return f"{self.start}{any_of(DISH_WORDS)}|{any_of(DISH_STYLES)}"

    @property
    def not_bowl(self) -> str:
        swapped = rf"{any_of(SWAPS)}\s+(?:to\s+|for\s+)?ramen noodles?"
        return rf"ramen\s+{any_of(NOT_AFTER_DISH)}|{any_of(NOT_A_BOWL)}|{swapped}|{any_of(FRIED)}[^.$]{{0,30}}ramen|ramen noodles?[^.$]{{0,20}}{any_of(FRIED[:2])}"

    @property
    def option(self) -> str:
        return rf"^\W*{any_of(OPTION_WORDS)}\b"

    @property
    def choice(self) -> str:
        broths = any_of([*CLASSIC_BROTHS.values(), *OTHER_BROTHS.values()])
        return rf"\b{any_of(CHOICE_WORDS)}\b|\bbroth (?:options|choices)\b|\bbroths\b|{broths}\w*(?: broth)?\s*(?:,\s*)?(?:\bor\b|/)\s*(?:spicy )?{broths}"

    def broth(self, pattern: str) -> str:
        return f"{self.start}(?:{pattern})"

    @property
    def noodle(self) -> str:
        return f"{self.start}ramen|ラーメン|noodles?"

    @property
    def noodle_name(self) -> str:
        return self.start + any_of(NOODLE_NAMES)

    @property
    def section(self) -> str:
        return rf"^\W*(?:{any_of(SECTION_BEFORE)} )?ramen{any_of(SECTION_AFTER)}?\W*$"

    @property
    def specials(self) -> str:
        return rf"^\W*(?:{any_of(SPECIAL_TIMES)}\s+)?{any_of(SPECIAL_NAMES)}\W*$"

    @property
    def bare(self) -> str:
        return r"^\W*ramen\W*(?:\$?\s?\d.*)?$"


JAVA = Patterns(r"(?<![a-z])", r"\$\s?\d{1,3}(?:\.\d{2})?|(?<![\d.])\d{1,3}\.\d{2}(?!\d)")
RE2 = Patterns(r"(?:^|[^a-z])", r"\$\s?\d{1,3}(?:\.\d{2})?|(?:^|[^\d.])\d{1,3}\.\d{2}(?:[^\d]|$)")
TOPPING = any_of(TOPPINGS)
#: "spicy" before a classic broth is that broth's flavour, no choice of its own.
SPICY_FLAVOUR = "spicy " + any_of(SPICY_KINDS)
assert all(re.compile(p) for p in (JAVA.dish, JAVA.not_bowl, JAVA.choice, TOPPING))
