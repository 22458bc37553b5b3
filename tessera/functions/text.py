"""Text normalisation of names and addresses, and the keys that blocking takes from them.

All of it is built-in column functions but for what Unicode needs (NFKC, case folding, accents, script, romanisation), which are
Arrow-batched pandas functions with a fast path for ASCII.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

# What counts as noise, and the legal forms known from the start.
NOISE_PREFIX = r"^(?U)\s*(--+|\*\*\*+|>>+|\[\.\.\]|#|@)(?U)\s*"
DOMAIN_SUFFIX = r"(?iU)(?<=\w)\.(com|in|fr|net|org|co)\b"
LEGAL_FORMS = ("llc", "inc", "corp", "corporation", "co", "ltd", "limited", "pvt", "private", "sarl", "sas", "sci", "gmbh", "plc")
POSTCODE = r"^\d{5,6}$"
HOUSE_NUMBER = r"^\d+[a-zA-Z]?$"
STRIPPED = ".,;:-"

_TRANSLITERATED = StructType([StructField("text", StringType()), StructField("changed", BooleanType())])


def is_latin(token: str) -> bool:
    """No letter of another script: digits, punctuation and combining marks pass; letters without a name do too."""
    return token.isascii() or all(unicodedata.name(c, "LATIN").startswith("LATIN") for c in token if c.isalpha())


#: Indic letters by the words of their Unicode names: "DEVANAGARI LETTER KA" is ka, without its vowel before a vowel sign.
_INHERENT = ("DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM")
_SIGNS = {"AA": "a", "I": "i", "II": "i", "U": "u", "UU": "u", "E": "e", "EE": "e", "AI": "ai", "O": "o", "OO": "o", "AU": "au", "VOCALIC R": "ri"}
# Sounds of letters by common romanisations (Cyrillic, Greek, and Korean initials, vowels and finals in Unicode's order).
_CYRILLIC = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґўђјљњћџ", "a b v g d e e zh z i y k l m n o p r s t u f kh ts ch sh shch - y - e yu ya i yi ye g u dj j lj nj c dz".replace("-", "").split(" ")))
_GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a v g d e z i th i k l m n x o p r s s t y f ch ps o".split()))
_INITIALS = "g kk n d tt r m b pp s ss  j jj ch k t p h".split(" ")
_VOWELS = "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split(" ")
_FINALS = " k k k n n n t l k m l l l p l m p p t t ng t t k t p t".split(" ")
#: Other scripts' letters by the last word of their names, where that is a letter's sound and not its own name.
_BY_SOUND = ("HIRAGANA", "KATAKANA", "THAI", "LAO", "GEORGIAN", "ARMENIAN", "ETHIOPIC", "KHMER", "MYANMAR", "SINHALA", "TIBETAN")
_ABJAD = {"ALEF": "a", "BEH": "b", "TEH": "t", "THEH": "th", "JEEM": "j", "HAH": "h", "KHAH": "kh", "DAL": "d", "THAL": "dh", "REH": "r", "ZAIN": "z", "SEEN": "s", "SHEEN": "sh", "SAD": "s", "DAD": "d", "TAH": "t", "ZAH": "z", "AIN": "a", "GHAIN": "gh", "FEH": "f", "QAF": "q", "KAF": "k", "LAM": "l", "MEEM": "m", "NOON": "n", "HEH": "h", "WAW": "w", "YEH": "y", "MARBUTA": "a", "MAKSURA": "a", "HAMZA": "", "PEH": "p", "TCHEH": "ch", "GAF": "g", "KEHEH": "k",
          "BET": "b", "GIMEL": "g", "DALET": "d", "HE": "h", "VAV": "v", "ZAYIN": "z", "HET": "h", "TET": "t", "YOD": "y", "LAMED": "l", "MEM": "m", "NUN": "n", "SAMEKH": "s", "AYIN": "a", "PE": "p", "TSADI": "ts", "QOF": "q", "RESH": "r", "SHIN": "sh", "TAV": "t"}


def _letter(c: str) -> str:
    """A letter of a script without inherent vowels. Han letters, whose sound depends on the language, and all others without a sound
    here are named by their code point, so that no word is lost and different words stay different."""
    low = c.lower()
    if low in _CYRILLIC or low in _GREEK:
        return _CYRILLIC.get(low, _GREEK.get(low, ""))
    code = ord(c) - 0xAC00
    if 0 <= code < 11172:
        return _INITIALS[code // 588] + _VOWELS[code % 588 // 28] + _FINALS[code % 28]
    name = unicodedata.name(c, "").split(" ")
    plain = unicodedata.normalize("NFKD", c)
    if plain != c and plain[0] != c:
        return "".join(x if x.isascii() else _letter(x) for x in plain if not unicodedata.combining(x))
    if name[0] in ("ARABIC", "HEBREW"):
        return next((_ABJAD[w] for w in reversed(name) if w in _ABJAD), f"u{ord(c):x}")
    if name[0] in _BY_SOUND:
        return name[-1].lower()
    return f"u{ord(c):x}"


def romanize(token: str) -> str:
    """Latin letters for a token of another script: Indic letters by their names, others by tables of sounds, Korean syllables by
    their parts. No token with a letter is lost."""
    out: list[str] = []
    for c in token:
        if c.isascii():
            out.append(c)
            continue
        name = unicodedata.name(c, "")
        words = name.split(" ")
        indic = words[0] in _INHERENT
        if indic and "VOWEL SIGN" in name:
            if out and out[-1].endswith("a") and len(out[-1]) > 1:
                out[-1] = out[-1][:-1]
            out.append(_SIGNS.get(name.split("VOWEL SIGN ")[1], ""))
        elif indic and "VIRAMA" in name:
            if out and out[-1].endswith("a"):
                out[-1] = out[-1][:-1]
        elif indic and ("ANUSVARA" in name or "CANDRABINDU" in name):
            out.append("n")
        elif indic and "VISARGA" in name:
            out.append("h")
        elif "DIGIT" in words:
            out.append(str(unicodedata.digit(c, "")))
        elif indic and "LETTER" in words:
            letter = words[words.index("LETTER") + 1 :]
            out.append(_SIGNS.get(" ".join(letter)) or letter[-1].lower())
        elif c.isalpha():
            out.append(_letter(c))
        else:
            out.append("".join(x for x in unicodedata.normalize("NFKD", c) if x.isascii()))
    text = "".join(out)
    # The last consonant's inherent vowel isn't spoken.
    if text.endswith("a") and len(token) > 1 and unicodedata.name(token[-1], "").startswith(_INHERENT) and "SIGN" not in unicodedata.name(token[-1], ""):
        text = text[:-1]
    return text


def transliterate(dictionary: dict[str, str] | None = None, fallback=romanize):
    """A column function: (text, changed). Tokens of other scripts are looked up in lower case, and romanised otherwise."""
    table = dictionary or {}

    @F.pandas_udf(_TRANSLITERATED)
    def run(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            tokens = (text or "").split()
            # Most texts have no letter of another script at all, which their distinct characters tell.
            if not text or text.isascii() or is_latin("".join(set(text))):
                out.append((" ".join(tokens), False))
                continue
            foreign = [not is_latin(t) for t in tokens]
            done = [(table.get(t.lower()) or fallback(t)) if f else t for t, f in zip(tokens, foreign)]
            out.append((" ".join(done), any(foreign)))
        return pd.DataFrame(out, columns=["text", "changed"])

    return run


@F.pandas_udf(StringType())
def strip_accents(texts: pd.Series) -> pd.Series:
    return texts.map(lambda s: s if s is None or s.isascii() else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)))


@F.pandas_udf(StringType())
def nfkc_casefold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda s: s if s is None else s.lower() if s.isascii() else unicodedata.normalize("NFKC", s).casefold())


def _fold(s: str | None) -> str | None:
    if s is None:
        return None
    if s.isascii():
        return s.lower()
    folded = unicodedata.normalize("NFKC", s).casefold()
    return "".join(c for c in unicodedata.normalize("NFKD", folded) if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def fold(texts: pd.Series) -> pd.Series:
    """NFKC, case folding, then accents off."""
    return texts.map(_fold)


@F.pandas_udf(BooleanType())
def latin(tokens: pd.Series) -> pd.Series:
    return tokens.map(lambda t: t is None or is_latin(t)).astype(bool)


def tokens(text: Column) -> Column:
    """Words between blanks, none for an empty text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda t: t != "")


def words(text: Column) -> Column:
    """tokens() of a text whose blanks are squeezed already: cut at single blanks, without a regular expression."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda t: t != "")


def squeeze(text: Column) -> Column:
    return F.array_join(tokens(text), " ")


def clean_noise(text: Column) -> Column:
    """One noise prefix off, domain suffixes off, separators to blanks, other punctuation dropped, blanks squeezed."""
    text = F.regexp_replace(text, NOISE_PREFIX, "")
    text = F.regexp_replace(text, DOMAIN_SUFFIX, "")
    text = F.regexp_replace(text, "[,;]", " ")
    return squeeze(F.regexp_replace(text, r"[.()\[\]/]", ""))


def consonant_skeleton(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{L}]|[aeiou]", "")


def apply_abbreviations(parts: Column, mapping: Column) -> Column:
    """parts with those in the map (one country's) replaced."""
    return F.transform(parts, lambda t: F.coalesce(F.try_element_at(mapping, t), t))


def split_legal_form(parts: Column, forms: Column) -> Column:
    """(rest, form): one trailing form of two words, else of one, is taken off."""
    n = F.size(parts)
    two = F.array_join(F.slice(parts, -2, 2), " ")
    one = F.element_at(parts, -1)
    drop = F.when((n >= 2) & F.array_contains(forms, two), 2).when((n >= 1) & F.array_contains(forms, one), 1).otherwise(0)
    rest = F.slice(parts, F.lit(1), n - drop)
    return F.struct(rest.alias("rest"), F.when(drop == 2, two).when(drop == 1, one).alias("form"))


def address_tokens(address: Column) -> Column:
    """Tokens between blanks and commas, stripped of outer punctuation."""
    stripped = F.transform(F.split(F.coalesce(address, F.lit("")), r"(?U)[\s,]+"), lambda t: F.btrim(t, F.lit(STRIPPED)))
    return F.filter(stripped, lambda t: t != "")


def postcode(address: Column) -> Column:
    """The first token of 5 or 6 digits that isn't the address's first token."""
    return F.try_element_at(F.filter(address_tokens(address), lambda t, i: (i > 0) & t.rlike(POSTCODE)), F.lit(1))


def house_numbers(address: Column) -> Column:
    """Tokens of digits, with a letter at most, in order, but for the one that is the postcode."""
    parts = address_tokens(address)
    at = F.array_position(F.transform(parts, lambda t, i: (i > 0) & t.rlike(POSTCODE)), F.lit(True))
    return F.filter(parts, lambda t, i: t.rlike(HOUSE_NUMBER) & (i != at - 1))


def char_ngrams(text: Column, n: int = 3) -> Column:
    """All substrings of n characters, in order; a shorter text itself; none of an empty text."""
    # One pass with a lookahead at every place but the middle of a surrogate pair.
    grams = F.regexp_extract_all(text, F.lit(rf"(?s)(?![\uDC00-\uDFFF])(?=(.{{{n}}}))"), F.lit(1))
    grams = F.when(F.length(text) < n, F.array(text)).otherwise(grams)
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(grams)


def number_street_keys(address: Column, numbers: Column) -> Column:
    """A house number and the token after it: 221_main."""
    parts = words(address)
    # Words beside those one place on; zipped, so that no lambda refers to the whole list.
    pairs = F.arrays_zip(parts.alias("a"), F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1))).alias("b"))
    hits = F.filter(pairs, lambda p: p["b"].isNotNull() & F.array_contains(numbers, p["a"]))
    return F.transform(hits, lambda p: F.concat(p["a"], F.lit("_"), p["b"]))


def word_keys(name: Column, address: Column, numbers: Column) -> Column:
    """The word channel's keys: both fields' tokens and the number keys, in one space of names."""
    keyed = F.when(F.size(numbers) > 0, number_street_keys(address, numbers)).otherwise(F.array().cast("array<string>"))
    return F.concat(words(name), words(address), keyed)


def ngram_keys(nospace: Column) -> Column:
    return char_ngrams(nospace, 3)


def embedding_text(name: Column, address: Column) -> Column:
    return F.trim(F.concat(F.coalesce(name, F.lit("")), F.lit(" "), F.coalesce(address, F.lit(""))))


def pair_text(name: Column, legal_form: Column, address: Column) -> Column:
    """name, legal form if any, then " | " and the address."""
    return F.concat(F.trim(F.concat_ws(" ", name, legal_form)), F.lit(" | "), F.coalesce(address, F.lit("")))


def judge_prompt(a: Column, b: Column, examples: list[tuple[str, str, bool]] = ()) -> Column:
    """A question whether two records name one business, after worked examples."""
    shown = "".join(f"Record A: {x}\nRecord B: {y}\nSame business? {'Yes' if same else 'No'}\n\n" for x, y, same in examples)
    head = "Decide whether the two records describe the same business. Answer Yes or No.\n\n"
    return F.concat(F.lit(head + shown + "Record A: "), a, F.lit("\nRecord B: "), b, F.lit("\nSame business? "))
