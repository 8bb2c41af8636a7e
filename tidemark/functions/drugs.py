"""Medicine and company text rules as JVM expressions; no Python runs per row."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import squeeze, unaccent

# --- fixed values --------------------------------------------------------------------------
# Units, word lists, patterns and codes below decide the resulting codes, so they are fixed.

DOSE = (
    r"\d+(?:[.,]\d+)?\s*(?:mg|g|mcg|µg|ug|iu|ui|ml|l|%|meq|mmol|dv|đv)"
    r"(?:\s*/\s*\d+(?:[.,]\d+)?\s*(?:ml|l))?"
)
BLANK_TEXTS = ["", "-", "--", "na", "nan", "none", "null"]
NOISE_PHRASES = [
    "tinh dau", "moi lo chua", "moi vien chua", "moi goi chua", "moi dung dich", "duoi dang",
    "dang", "dung dich", "vi hat", "chua", "moi", "td", "dl", "thien nhien", "tu nhien", "acid",
    "tuong ung", "tuong duong",
]
FORM_WORDS = [
    "tablet", "tablets", "tab", "capsule", "capsules", "cap", "syrup", "solution", "powder",
    "granule", "suspension", "inj", "injection", "ampoule", "vial", "drop", "drops", "spray",
    "cream", "gel", "ointment", "oral", "iv", "im", "sc", "topical", "film", "coated", "retard",
    "sr", "mr", "xr", "vien", "ong", "lo", "goi", "chai", "hop", "vi", "mg", "g", "mcg", "ug",
    "iu", "ui", "ml", "l", "%", "hv", "opc",
]
SALT_WORDS = [
    "citrat", "citrate", "hydrochloride", "hcl", "sulfate", "sulphate", "phosphate", "tartrate",
    "maleate", "mesylate", "besylate", "nitrate", "acetate", "acetat", "succinate",
]
FORM_PREFIX = (
    r"^(?:duoi\s+dang|dang|as|in\s+the\s+form\s+of|under\s+the\s+form\s+of|in\s+form\s+of|"
    r"in\s+the\s+form)\b"
)
ALIAS = (
    r"\bnicotinamid(e)?\b|\bniacinamid(e)?\b|\bvitamin\s*pp\b|\bpyridox(in|ine)\b|"
    r"\bthiamin(e)?\b|\bcobalamin\b|\bcholecalciferol\b|\bretinol\b|\bretinyl\b|"
    r"\btocopheryl\b|\btocopher\w*\b|\btocofer\w*\b"
)
TOCOPHEROL = r"\btocofer\w*\b|\btocopher\w*\b|\btocopheryl\b|\balphatocopheryl\b"
# Pattern, canonical name; the first that matches wins.
FAMILIES = [
    (r"\bvitamin\s*c\b|\bascorbic\b|\bacid\s*ascorbic\b", "ascorbic"),
    (r"\bvitamin\s*e\b|\bvitamine\b|\btocofer\w*\b|\btocopher\w*\b", "tocopheryl acetate"),
    (r"\bvitamin\s*d3\b|\bcholecalciferol\b|\bcolecalciferol\b", "cholecalciferol"),
    (r"\bvitamin\s*a\b|\bretinol\b|\bretinyl\b", "retinol"),
    (r"\bvitamin\s*b1\b|\bthiamin(e)?\b", "thiamine"),
    (r"\bvitamin\s*b6\b|\bpyridox(in|ine)\b", "pyridoxine"),
    (r"\bvitamin\s*b12\b|\bcobalamin\b|\bcyanocobalamin\b", "cyanocobalamin"),
    (r"\bvitamin\s*k1\b|\bphytomenadion(e)?\b|\bphytonadion(e)?\b", "phytomenadione"),
    (r"\bvitamin\s*pp\b|\bnicotinamid(e)?\b|\bniacinamid(e)?\b", "nicotinamide"),
]
SAME_AS = [
    (r"\bacetaminophen\b", "paracetamol"),
    (r"\bpanadol\b", "paracetamol"),
    (r"\bpara\b", "paracetamol"),
    (r"\bnicotinamid\b", "nicotinamide"),
    (r"\bniacinamid\b", "nicotinamide"),
]
ACTIVE_CODES = {
    "paracetamol": "PARA",
    "ascorbic": "ASCORB",
    "tocopheryl acetate": "TOCOPH",
    "cholecalciferol": "CHOLE",
    "retinol": "RETIN",
    "thiamine": "THIAM",
    "pyridoxine": "PYRIDO",
    "cyanocobalamin": "CYANO",
    "phytomenadione": "PHYTOM",
    "nicotinamide": "NICOTI",
}
PHRASE_IGNORE = [
    "hoat", "huyet", "trung", "uong", "extractum", "extract", "chiet", "xuat", "tu", "ty", "ti",
    "le", "ratio", "10", "1", "vien", "ong", "lo", "goi", "chai", "hop", "vi",
]
EXTRACT_WORD, EXTRACT_FORMS = "cao", ["dac", "kho", "long", "mem", "hon", "hop"]
THREE_TOKEN_PHRASE = ["ban", "ha", "che"]
# Removed one after the other, in this order, anywhere in a company name.
COMPANY_PHRASES = [
    r"cong\s+ty", "cty", r"chi\s+nhanh", r"van\s+phong\s+dai\s+dien", "vpdd", r"trung\s+tam",
    r"nha\s+may", "xuong", r"co\s+so",
    r"tnhh\s*mtv", r"tnhh\s*1tv", "tnhh", "mtv", r"mot\s+thanh\s+vien", r"co\s+phan", "cophan",
    "cp", "ltd", "limited", "inc", "incorporated", "corp", "corporation", "llc", "plc", "llp",
    "lp", "jsc", r"j\s+s\s+c", "gmbh", r"g\s+m\s+b\s+h", r"ges\s+m\s+b\s+h", r"m\s+b\s+h", "kg",
    "ag", "sa", "sarl", "spa", r"s\s+p\s+a", "bv", "nv", "oy", "ab", "as", "aps", "kft",
    "nfg", "mfg", "manufacturing",
    r"san\s+xuat", r"ban\s+thanh\s+pham", r"dong\s+goi", r"so\s+cap", r"thuong\s+mai",
    r"gia\s+cong", r"phan\s+phoi", r"nhap\s+khau", r"xuat\s+khau", r"co\s+so\s+san\s+xuat",
    r"nha\s+san\s+xuat", r"xuong\s+san\s+xuat", r"noi\s+san\s+xuat", r"dia\s+chi",
    r"nha\s+may", r"xi\s+nghiep", "tram", r"trung\s+tam", r"vat\s+tu\s+y\s+te", r"so\s+cap",
    r"thu\s+cap", r"dong\s+goi", "ttbyt",
    "va", "nha", r"dong\s+goi\s+so\s+cap", r"dong\s+goi\s+thu\s+cap", r"xuat\s+xuong", "xuat",
    "thuoc", "tai", r"trang\s+thiet\s+bi\s+y\s+te", "ttbyt", r"nhan\s+gia\s+cong",
    r"nhan\s+chuyen\s+giao\s+cong\s+nghe", r"cong\s+nghe\s+cao",
]
COUNTRIES = [
    r"viet\s+nam", "vietnam", "usa", r"u\s+s\s+a", "japan", "korea", "china", "taiwan",
    "thailand", "france", "germany",
]
ADDRESS_WORDS = [
    r"dia\s+chi", "address", "street", "st", "road", "rd", "ave", "avenue", "blvd", "boulevard",
    "way", "lane", "ln", "travessia", "travesia",
]
# --- end of fixed values -------------------------------------------------------------------

_DOSE = f"(?iU){DOSE}"
_EQUIVALENT = r"(?iU)\btuong\s+duong\s+voi\b|\btương\s+đương\s+với\b"
_SEPARATOR = r"(?iU)\s*(?:\+|;|,|/|\bva\b|\bvà\b|&)\s*"
_BRACKETED = r"[\(\[\{]([^\)\]\}]+)[\)\]\}]"


def _any_word(words: list[str]) -> str:
    """One alternation, longest first, so that a phrase wins over its own parts."""
    return r"\b(?:" + "|".join(sorted(words, key=len, reverse=True)) + r")\b"


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also inside array lambdas, where Spark does
    not share repeated sub-expressions."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _plain(c: Column) -> Column:
    return F.lower(unaccent(c))


def is_blank(c: Column) -> Column:
    return F.lower(F.trim(_text(c))).isin(*BLANK_TEXTS)


# --- doses ---------------------------------------------------------------------------------


def normalize_dose(c: Column) -> Column:
    """``1,5 mg / 1 ml`` -> ``1.5MG/ML``."""
    s = F.upper(F.regexp_replace(_text(c), r"\s+", ""))
    s = F.replace(F.replace(s, F.lit("UI"), F.lit("IU")), F.lit(","), F.lit("."))
    s = F.regexp_replace(s, r"[^A-Z0-9+/%.\-]", "")
    return F.replace(s, F.lit("/1ML"), F.lit("/ML"))


def first_dose(c: Column) -> Column:
    return normalize_dose(F.regexp_extract(_text(c), _DOSE, 0))


def all_doses(c: Column) -> Column:
    found = F.regexp_extract_all(_text(c), F.lit(f"({_DOSE})"), F.lit(0))
    return F.filter(F.transform(found, normalize_dose), lambda d: d != "")


def remove_doses(c: Column) -> Column:
    return squeeze(F.regexp_replace(_text(c), _DOSE, " "))


def is_only_dose(c: Column) -> Column:
    """Nothing but doses joined by ``+``."""

    def doses_only(s: Column) -> Column:
        parts = F.filter(F.split(s, r"\+"), lambda p: p != "")
        return (s != "") & F.forall(parts, lambda p: p.rlike(f"^(?:{_DOSE})$"))

    return c.isNotNull() & _let(normalize_dose(F.trim(_text(c))), doses_only)


# --- noise, brackets, segments -------------------------------------------------------------


def remove_noise(c: Column) -> Column:
    """Lower-case text without accents and noise phrases."""
    return squeeze(F.regexp_replace(_plain(_text(c)), _any_word(NOISE_PHRASES), " "))


def drop_equivalent(c: Column) -> Column:
    """Text before "equivalent to"."""
    return F.trim(F.split(_text(c), _EQUIVALENT, 2).getItem(0))


def kept_words(c: Column) -> Column:
    """Words that are neither dosage forms nor salts, joined by blanks."""
    words = F.split(squeeze(c), " ")
    stop = FORM_WORDS + SALT_WORDS
    return F.array_join(F.filter(words, lambda w: ~w.isin(*stop) & (w != "")), " ")


def segments(c: Column) -> Column:
    """Candidate substances: the text outside brackets, then bracketed texts that are neither a
    form remark nor an alias, each cut at separators."""
    s = _text(c)
    outside = F.array(squeeze(F.regexp_replace(s, _BRACKETED, " ")))
    inside = F.filter(
        F.transform(F.regexp_extract_all(s, F.lit(_BRACKETED), F.lit(1)), squeeze),
        lambda b: ~squeeze(_plain(b)).rlike(FORM_PREFIX) & ~_plain(b).rlike(ALIAS),
    )
    pieces = F.flatten(F.transform(F.concat(outside, inside), lambda p: F.split(p, _SEPARATOR)))
    return F.filter(F.transform(pieces, squeeze), lambda p: p != "")


# --- canonical names and codes -------------------------------------------------------------


def family(c: Column) -> Column:
    """Canonical vitamin name, null when the text belongs to no family."""

    def first_match(t: Column) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for pattern, name in FAMILIES:
            out = out.when(t.rlike(pattern), F.lit(name))
        return out

    return _let(squeeze(F.regexp_replace(_plain(c), r"(?U)[^\w\s\-]", " ")), first_match)


def _bare(c: Column) -> Column:
    """Text before "equivalent to", without doses and noise, lower case, no accents."""
    return remove_noise(remove_doses(drop_equivalent(c)))


def canonical(c: Column) -> Column:
    """One name per substance, however it is written."""

    def name(s: Column) -> Column:
        words = kept_words(F.regexp_replace(s, r"(?U)[^\w\s\-]", " "))
        for pattern, other in SAME_AS:
            words = F.regexp_replace(words, pattern, other)
        return F.when(s.rlike(TOCOPHEROL), F.lit("tocopheryl acetate")).otherwise(
            F.coalesce(family(s), squeeze(words))
        )

    return _let(_bare(c), name)


def canonical_input(segment: Column) -> Column:
    """A segment as the canonical step takes it: doses and noise already removed once."""
    return remove_noise(remove_doses(segment))


def phrase_code(c: Column) -> Column:
    """Code of a name in the local language: its first two words, three for one fixed phrase;
    an extract keeps the extract word, its form, and two words of the name."""
    words = F.filter(
        F.split(squeeze(F.regexp_replace(_bare(c), r"[^a-z0-9\s]", " ")), " "),
        lambda w: (w != "") & ~w.isin(*PHRASE_IGNORE),
    )

    def code(w: Column) -> Column:
        n = F.size(w)
        three = (n >= 3) & (F.slice(w, 1, 3) == F.array(*map(F.lit, THREE_TOKEN_PHRASE)))
        plain = F.slice(w, F.lit(1), F.when(three, 3).otherwise(2))
        has_form = (n > 1) & F.get(w, F.lit(1)).isin(*EXTRACT_FORMS)
        head = F.when(has_form, F.lit(2)).otherwise(F.lit(1))
        two_more = F.slice(w, head + 1, F.lit(2))
        last_word = F.slice(w, F.greatest(n, F.lit(1)), F.lit(1))
        tail = F.when(n >= head + 2, two_more).otherwise(last_word)
        extract = F.concat(F.slice(w, F.lit(1), head), tail)
        chosen = F.when(F.get(w, F.lit(0)) == EXTRACT_WORD, extract).otherwise(plain)
        return F.upper(F.array_join(chosen, ""))

    return _let(words, code)


def active_code(name: Column, segment: Column) -> Column:
    """Fixed code of a canonical name, else phrase code if the segment carries accents, else
    the first six characters."""
    lookup = F.create_map(*[F.lit(x) for pair in ACTIVE_CODES.items() for x in pair])
    first_word = F.regexp_replace(F.split(name, r"\s+").getItem(0), "[^a-z0-9]", "")
    return F.when(name == "", F.lit("")).otherwise(
        F.coalesce(
            F.try_element_at(lookup, name),
            F.when(unaccent(segment) != segment, phrase_code(segment)),
            F.upper(F.substring(first_word, 1, 6)),
        )
    )


def active_pairs(active: Column, concentration: Column, limit: int = 2) -> Column:
    """First ``limit`` distinct substances as array<struct<code, dose, name>>.

    A substance without a dose of its own takes the dose at its position in the
    concentration text.  The fold over the segments runs in the JVM.
    """
    spare = F.when(is_blank(concentration), F.array().cast("array<string>")).otherwise(
        all_doses(concentration)
    )
    found = F.transform(
        segments(drop_equivalent(active)),
        lambda seg: F.struct(
            seg.alias("seg"),
            canonical(canonical_input(seg)).alias("name"),
            first_dose(seg).alias("dose"),
        ),
    )
    empty = F.array().cast("array<struct<seg:string,name:string,dose:string>>")

    def step(kept: Column, item: Column) -> Column:
        known = F.exists(kept, lambda k: k["name"] == item["name"])
        spare_dose = F.coalesce(F.get(spare, F.size(kept)), F.lit(""))
        dose = F.when(item["dose"] != "", item["dose"]).otherwise(spare_dose)
        more = F.array(F.struct(item["seg"].alias("seg"), item["name"].alias("name"), dose.alias("dose")))
        skip = (item["name"] == "") | known | (F.size(kept) >= limit)
        return F.when(skip, kept).otherwise(F.concat(kept, more))

    return F.transform(
        F.aggregate(found, empty, step),
        lambda p: F.struct(
            active_code(p["name"], p["seg"]).alias("code"), p["dose"].alias("dose"), p["name"].alias("name")
        ),
    )


def one_per_code(pairs: Column) -> Column:
    """The pairs reduced to one for each code, in the order of the codes: the first that has a
    dose, else the first.  Pairs without a code go."""
    coded = F.filter(pairs, lambda p: p["code"] != "")

    def chosen(code: Column) -> Column:
        own = F.filter(coded, lambda p: p["code"] == code)
        return F.coalesce(F.get(F.filter(own, lambda p: p["dose"] != ""), F.lit(0)), F.get(own, F.lit(0)))

    return F.transform(F.array_distinct(F.transform(coded, lambda p: p["code"])), chosen)


def drug_code(kept: Column) -> Column:
    """``CODE+CODE_DOSE+DOSE`` of pairs that ``one_per_code`` has reduced."""
    doses = F.filter(F.transform(kept, lambda p: p["dose"]), lambda d: d != "")
    code_text, dose_text = F.array_join(F.transform(kept, lambda p: p["code"]), "+"), F.array_join(doses, "+")
    return F.when((code_text != "") & (dose_text != ""), F.concat_ws("_", code_text, dose_text)).otherwise(
        code_text
    )


# --- companies -----------------------------------------------------------------------------


def normalize_company(c: Column) -> Column:
    """Company name without legal forms, activities, trailing country, address and repeats."""
    # (?U): letters of every script are word characters, so no name is emptied.
    s = squeeze(F.regexp_replace(_plain(_text(c)), r"(?U)[^\w\s]", " "))
    s = reduce(lambda t, p: F.regexp_replace(t, rf"(?U)\b{p}\b", " "), COMPANY_PHRASES, s)
    s = reduce(lambda t, p: F.regexp_replace(t, rf"(?:\s+{p})$", ""), COUNTRIES, squeeze(s))
    s = F.regexp_replace(s, r"(?U)\b(?:" + "|".join(ADDRESS_WORDS) + r")\b.*$", " ")
    s = F.regexp_replace(s, r"(?U)\b\d{4,}\b", " ")
    s = F.regexp_replace(s, r"(?U)\b[a-z]*\d+[a-z]+\b|\b[a-z]+\d+[a-z]*\b", " ")
    return F.initcap(drop_repeat(squeeze(s)))


def drop_repeat(c: Column) -> Column:
    """``a b a b c`` -> ``a b``: the longest leading phrase of two or more words that repeats."""

    def shorten(words: Column) -> Column:
        half = F.floor(F.size(words) / 2).cast("int")
        sizes = F.when(half >= 2, F.sequence(half, F.lit(2), F.lit(-1)))
        repeated = F.filter(
            sizes, lambda n: F.slice(words, F.lit(1), n) == F.slice(words, n + 1, n)
        )
        size = F.coalesce(F.get(repeated, F.lit(0)), F.size(words))
        return F.array_join(F.slice(words, F.lit(1), size), " ")

    return _let(F.split(c, " "), shorten)


def company_code(c: Column) -> Column:
    """First four letters of a single word, else initials with short unit numbers in full."""
    return code_of_normal(normalize_company(c))


def code_of_normal(normal: Column) -> Column:
    """``company_code`` of a name that is normalised already."""

    def code(words: Column) -> Column:
        initials = F.transform(
            words, lambda w: F.when(w.rlike("^[0-9]{1,3}$"), w).otherwise(F.substring(w, 1, 1))
        )
        single = F.substring(F.get(words, F.lit(0)), 1, 4)
        return F.upper(F.when(F.size(words) == 1, single).otherwise(F.array_join(initials, "")))

    return _let(F.split(normal, " "), code)
