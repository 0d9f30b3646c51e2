"""Text functions as Columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lines(text: Column, shortest: int = 3, longest: int = 160) -> Column:
    """Array of a text's lines: split at newlines, at three or more spaces and at bullets; spaces collapsed; by length."""
    parts = F.split(text, r"\n|(?<=\S) {3,}(?=\S)|[•·|]")
    clean = F.transform(parts, lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    return F.filter(clean, lambda x: (F.length(x) >= shortest) & (F.length(x) <= longest))


def line_key(line: Column, longest: int = 60) -> Column:
    """A line's key: lower case, prices away, letters and spaces kept (a-z, kana, CJK), spaces collapsed."""
    bare = F.regexp_replace(F.lower(line), r"\$\s?\d{1,3}(?:\.\d{2})?|(?<![\d.])\d{1,3}\.\d{2}(?!\d)", "")
    kept = F.regexp_replace(bare, "[^a-z぀-ヿ一-鿿 ]", " ")
    return F.substring(F.trim(F.regexp_replace(kept, " +", " ")), 1, longest)


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def words(text: Column, filler: tuple[str, ...] = (), shortest: int = 3) -> Column:
    """Distinct lower-case alphanumeric words of a minimum length that are not filler."""
    parts = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: F.length(w) >= shortest)
    return F.array_except(parts, F.array(*[F.lit(x) for x in filler])) if filler else F.array_distinct(parts)


def claim_code(host: Column, salt: str, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat(F.lit(salt), host), 256), 1, 6))


def nick_key(name: Column) -> Column:
    """A nickname's key: lower case, look-alike digits undone, other signs away, repeated letters squeezed."""
    plain = F.translate(F.lower(name), "0134578$@", "oieastbsa")
    return F.regexp_replace(F.regexp_replace(plain, "[^a-z]", ""), r"(.)\1+", "$1")


def all_words(hay: Column, query: str) -> Column:
    """Every word of the query occurs in the text (both lower-cased; fold accents before, if they are to be ignored)."""
    out = F.lit(True)
    for word in query.lower().split():
        out = out & F.contains(F.lower(hay), F.lit(word))
    return out


def joined_address(*parts: Column) -> Column:
    """Non-empty parts joined by ", "; null if there is none."""
    return F.nullif(F.concat_ws(", ", *[F.nullif(F.trim(p), F.lit("")) for p in parts]), F.lit(""))


def split_address(address: Column) -> dict[str, Column]:
    """Street, city and state of "street, city, ST [zip]"."""
    parts = F.split(address, ", *")
    state = F.regexp_extract(F.element_at(parts, -1), r"^([A-Z]{2})\b", 1)
    return {"street": F.element_at(parts, 1), "city": F.try_element_at(parts, F.lit(-2)), "state": F.nullif(state, F.lit("")), "house": F.nullif(F.regexp_extract(address, r"^(\d+)\b", 1), F.lit(""))}


def folded(text: Column) -> Column:
    """Lower case without accents (NFKD, combining marks away): an Arrow function, since no expression decomposes characters."""
    def fold(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c)))

    return F.pandas_udf(fold, "string")(text)


def plain_slug(text: Column, default: str = "city") -> Column:
    """A slug without accents; `default` where nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(folded(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(bare == "", default).otherwise(bare)


def name_key(name: Column, filler: list[str]) -> Column:
    """Letters and digits of a name without accents and filler words."""
    bare = F.regexp_replace(folded(F.coalesce(name, F.lit(""))), r"\b(?:" + "|".join(filler) + r")\b", " ")
    return F.regexp_replace(bare, "[^a-z0-9]+", "")


def clock_label(minute: Column) -> Column:
    """"noon", "midnight", "9 am", "9:30 pm" of minutes, which may pass midnight."""
    m = minute % 1440
    hour = (F.floor(m / 60) + 11) % 12 + 1
    text = F.concat(hour.cast("string"), F.when(m % 60 > 0, F.concat(F.lit(":"), F.lpad((m % 60).cast("string"), 2, "0"))).otherwise(F.lit("")), F.when(m < 720, " am").otherwise(F.lit(" pm")))
    return F.when(m == 0, "midnight").when(m == 720, "noon").otherwise(text)


def cut_at_word(text: Column, most: int = 60) -> Column:
    """A text of at most `most` characters, cut at the last space inside."""
    short = F.substring(text, 1, most)
    cut = F.regexp_extract(short, r"^(.*)\s\S*$", 1)
    return F.when(F.length(text) <= most, text).when(cut != "", cut).otherwise(short)


def blocked_nick(key: Column, listed: list[str]) -> Column:
    """A nickname's key contains a listed word, itself squeezed the same way."""
    return F.exists(F.array(*[F.lit(w) for w in listed]), lambda w: F.contains(key, F.regexp_replace(w, r"(.)\1+", "$1")))


# Words of a street that tell nothing apart.
STREET_FILLER = "st street rd road ave avenue blvd dr drive ln lane way ct pl pkwy parkway hwy highway n s e w north south east west ne nw se sw ste suite unit us the and at of".split()


def address_parts(address: Column) -> dict[str, Column]:
    """Street, city, state and house number of "street, city, ST [zip]"; all but the house number null where there is no state.

    States may be codes or names. Where a suite stands in the city's place the part before it is the city. Words of a city all in
    one case are capitalized, but for codes of up to three capitals."""
    from .extract import STATES

    parts = F.filter(F.transform(F.split(address, ","), lambda x: F.trim(x)), lambda x: x != "")
    last = F.trim(F.regexp_replace(F.try_element_at(parts, F.lit(-1)), r"\s*\d{5}(?:-\d{4})?$", ""))
    codes = F.create_map(*[F.lit(x) for name, code in STATES.items() for x in (name.lower(), code)])
    state = F.when(F.length(last) == 2, F.upper(last)).otherwise(F.try_element_at(codes, F.lower(last)))
    second, third = F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-3))
    raw = F.when(~second.rlike(r"\d"), second).when((F.size(parts) >= 4) & ~third.rlike(r"\d"), third)
    ok = (F.size(parts) >= 3) & state.isin(*STATES.values()) & raw.isNotNull()
    one_case = lambda w: (w == F.lower(w)) | (w == F.upper(w))
    cased = F.transform(F.split(raw, r"\s+"), lambda w: F.when(w.rlike("^[A-Z]{1,3}$"), w).when(one_case(w) & w.rlike("(?i)[a-z]"), F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 100)))).otherwise(w))
    city = F.array_join(cased, " ")
    street = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(0))), ", ")
    return {"street": F.when(ok, street), "city": F.when(ok, city), "state": F.when(ok, state), "house": F.nullif(F.regexp_extract(address, r"^(\d+)\b", 1), F.lit(""))}


def street_words(address: Column) -> Column:
    """Distinct words of an address's street that tell it apart: no numbers, no filler."""
    parts = F.split(F.lower(F.coalesce(F.split(address, ",")[0], F.lit(""))), "[^a-z0-9]+")
    return F.array_distinct(F.filter(parts, lambda w: (w != "") & ~w.rlike(r"^\d+$") & ~w.isin(*STREET_FILLER)))


def is_shop_key(key: Column) -> Column:
    return key.rlike(r"^[a-z0-9.\-]{1,80}@-?\d{1,3}\.\d{2},-?\d{1,3}\.\d{2}$")


def clean_tag(tag: Column) -> Column:
    return F.substring(F.regexp_replace(F.lower(F.coalesce(tag, F.lit(""))), r"[^a-z0-9_.\-]", ""), 1, 32)


def clean_signature(signature: Column) -> Column:
    """Hexadecimal digits of a signature, 16 to 64 of them; null below."""
    digits = F.substring(F.regexp_replace(F.lower(signature), "[^0-9a-f]", ""), 1, 64)
    return F.when(F.length(digits) >= 16, digits)
