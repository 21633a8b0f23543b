"""Column functions that clean scanned text. All are native expressions.

Patterns carry ``(?U)`` where letters beyond ASCII count, as they do in the
corpus these functions are for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that scanning turns into others, wrong and right.
WRONG_WORDS = """
vhole whole | Vhole Whole | vhich which | Vhich Which | vith with | vould would | Vould Would | vork work | Vork Work
vorld world | Vorld World | vhen when | Vhen When | vere were | Vere Were | vay way | vill will
lias has | Lias Has | tlie the | Tlie The | llie the | niatter matter | Niatter Matter
iiian man | hfe life | Hfe Life | CHAFFER CHAPTER | Chapteri Chapter 1
JudaeoChristian Judaeo-Christian | senseperception sense-perception | Senseperception Sense-perception
liave have | liat that | nianv many | jov joy | gocxl good | hojx hope | happv happy | happilv happily | wdth with | tliat that
Citxl God | Gixl God | Gtxl God | Sirints Saints
"""

# Spellings that scanning leaves where an italic letter stood, as patterns, and what they stand for.
BACKSLASH_REPAIRS = (
    (r"\bha\\e\b", "have"), (r"\bli\\e\b", "live"), (r"\blo\\e\b", "love"), (r"\bgi\\e\b", "give"), (r"\bgi\\en\b", "given"), (r"\bgi\\ing\b", "giving"),
    (r"\bmo\\e\b", "move"), (r"\bmo\\ement\b", "movement"), (r"\bne\\v\b", "new"), (r"\be\\en\b", "even"), (r"\be\\er\b", "ever"), (r"\be\\ery\b", "every"),
    (r"\bc\\cn\b", "even"), (r"\bdi\\ine\b", "divine"), (r"\bpri\\ate\b", "private"), (r"\bser\\e\b", "serve"), (r"\bser\\ed\b", "served"), (r"\bser\\ing\b", "serving"),
    (r"\bser\\ice", "service"), (r"\bobser\\e", "observe"), (r"\bpreser\\e", "preserve"), (r"\bcon\\ert", "convert"), (r"\bcon\\ince", "convince"), (r"\bin\\ol", "invol"),
    (r"\bre\\eal", "reveal"), (r"\bre\\olution", "revolution"), (r"\bbelie\\e", "believe"), (r"\bde\\'eloped\b", "developed"), (r"\bde\\elop", "develop"),
    (r"\bdepri\\'?ation\b", "deprivation"), (r"\be\\'?ade\b", "evade"), (r"\bli\\'?ing\b", "living"), (r'\bvegetati\\"?e\b', "vegetative"),
    (r"\bcollecti\\'?ely\b", "collectively"), (r"\bcollecti\\'?e\b", "collective"), (r"\bse\\eral\b", "several"), (r"\bacti\\e\b", "active"), (r"\bacti\\ely\b", "actively"),
    (r"\bpro\\ide", "provide"), (r"\\arious\b", "various"), (r"\\alidate", "validate"), (r"\b\\'erbal\b", "verbal"), (r"\bE\\'OLUTION\b", "EVOLUTION"),
    (r"\bsophistr\\'(?!\w)", "sophistry"), (r"\btheor\\'(?!\w)", "theory"), (r"\bglor\\'?(?!\w)", "glory"), (r"\bPurgator\\'?-?(?!\w)", "Purgatory"), (r"\bfacult\\'?i?\b", "faculty"),
    (r"\bwor\\s\b", "works"), (r"\bBoo\\s\b", "Books"), (r"\bBoo\\\b", "Book"), (r"\bDic\\\b", "Dick"), (r"\bbul\\\b", "bulk"), (r"\bloo\\not\b", "look not"),
    (r"\\\\'?hich\b", "which"), (r"\bpo\\\\'?er\b", "power"), (r"\bsho\\\\'?ing\b", "showing"), (r"\bgro\\\\'?th\b", "growth"), (r"\bgro\\\\n\b", "grown"),
    (r"\bcommon\\\\\^?\s*ealth\b", "commonwealth"), (r"\\\^'?orld\b", "world"), (r"\\\^['\x20]rites\b", "writes"), (r"\bspa\\esty\b", "spakest"), (r"\bwhate\\-er\b", "whatever"),
    (r"\bx\\ristotle\b", "Aristotle"), (r"\bx\\nimal\b", "Animal"), (r"\\ND\b", "AND"), (r"\\vc\b", "we"), (r"\bDar\\vin\b", "Darwin"),
)

# The same for ligatures and other marks.
MARK_REPAIRS = (
    ("SCHLEIERMACHFR", "SCHLEIERMACHER"), ("Maimomdes", "Maimonides"), ("m;»chine", "machine"), (r"\bC»<xl\b", "God"), (r"\bCi[0O]ti\b|\bC»\w+\b", "God"),
    (r"\bScotus Engena\b", "Scotus Erigena"), ("Judaeo-christian", "Judaeo-Christian"), (r"\bDarw in\b", "Darwin"), (r"\bdoc s\b", "does"),
    (r"'?\bI'he\b", "The"), (r"\bi'hc\b", "the"), (r"'I'his\b", "This"),
    (r"\bIx[*:](?!\w)", "be"), (r"\bIx\^(\w+)", "be$1"), (r"\bIx-causc\b", "because"), (r"\bIx-twecn\b", "between"), (r"\bIx- (\w+)", "be $1"), (r"\bIx-(\w+)", "be$1"), (r"\bIx\b(?=\s+[A-Z])", "In"),
    (r"\bdisjunctit['\"]?e\\?['\"]?\b", "disjunctive"), (r"\bma\^e\b", "make"), (r"\.ristotle\b", "Aristotle"), (r"\bw'ith\b", "with"),
    (r"\bm\.an\b", "man"), (r"\bm\.atter\b", "matter"), (r"\bam\.ong\b", "among"), (r"\bam\.ount\b", "amount"),
)

#: Words after which "arc" is a curve and no misread "are".
DETERMINERS = "an the this that each every any no its their his her our your one".split()

#: Small words that scanning glues to a capital after them.
GLUED = "of in to by as".split()


def wrong_words() -> dict[str, str]:
    pairs = [entry.strip().split(" ", 1) for line in WRONG_WORDS.strip().splitlines() for entry in line.split("|")]
    return {wrong: right for wrong, right in pairs}


def tokens(text: Column) -> Column:
    """Words (letters, digits, _) and what stands between them, in order; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"), F.lit(0))


_BEFORE, _AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def fix_words(text: Column, words: dict[str, str] | None = None) -> Column:
    """Misread words put right: marked in one pass, then replaced where they are marked.

    "oi", "ol" and "ot" before a lower-case word become "of"; "docs" not before
    a full stop becomes "does"; "arc" becomes "are" unless a determiner stands
    before it.
    """
    words = words or wrong_words()
    marked = F.regexp_replace(text, f"{_BEFORE}({'|'.join(words)}){_AFTER}", "\uE000$1\uE001")
    for wrong, right in words.items():
        marked = F.replace(marked, F.lit(f"\uE000{wrong}\uE001"), F.lit(right))
    text = marked
    text = F.regexp_replace(text, rf"{_BEFORE}(?:oi|ol|ot){_AFTER}(?=\s+[a-z])", "of")
    text = F.regexp_replace(text, rf"{_BEFORE}docs{_AFTER}(?!\s*\.)", "does")
    # curves are marked, the others put right, the mark taken out
    curve = F.regexp_replace(text, rf"{_BEFORE}((?i:{'|'.join(DETERMINERS)}))(\s+)arc{_AFTER}", "$1$2a\uE000rc")
    curve = F.replace(F.regexp_replace(curve, f"{_BEFORE}arc{_AFTER}", "are"), F.lit("a\uE000rc"), F.lit("arc"))
    return F.when(text.contains("arc"), curve).otherwise(text)


def _repaired(text: Column, repairs: tuple[tuple[str, str], ...]) -> Column:
    for pattern, right in repairs:
        text = F.regexp_replace(text, f"(?U){pattern}", right)
    return text


def fix_marks(text: Column) -> Column:
    """Ligatures, carets, stray points and known garbled names."""
    return _repaired(text, MARK_REPAIRS)


def fix_backslashes(text: Column) -> Column:
    """Words with one or two backslashes (or more marks) in place of a letter."""
    return F.when(text.contains("\\"), _repaired(text, BACKSLASH_REPAIRS)).otherwise(text)


def unglue(text: Column) -> Column:
    """A space between a small word and the capitalised word glued to it, and runs of spaces made one."""
    text = F.regexp_replace(text, r"\b(%s)([A-Z][a-z]{2,})\b" % "|".join(GLUED), "$1 $2")
    return F.regexp_replace(text, " {2,}", " ")


def correct(text: Column) -> Column:
    """The whole chain of corrections, with stray page headers taken out."""
    text = F.regexp_replace(text, r"\s+[0-9]{3,4}\s+[A-Z]{3,}\s*\n", "\n")
    return unglue(fix_words(fix_backslashes(fix_marks(text))))


def fix_terminal_v(text: Column, known: set[str] | frozenset[str]) -> Column:
    """"onlv" to "only" where only the spelling with y is in the bounded word list ``known``; without a list nothing changes."""
    if not known:
        return text
    words = F.array(*[F.lit(w) for w in sorted(known)])
    y = lambda x: F.concat(F.substr(x, F.lit(1), F.length(x) - 1), F.lit("y"))
    return F.array_join(F.transform(tokens(text), lambda x: F.when(x.rlike("^[A-Za-z]{3,}v$") & ~F.array_contains(words, x) & F.array_contains(words, y(x)), y(x)).otherwise(x)), "")


def dehyphenate(text: Column) -> Column:
    """Words broken over a line end joined."""
    return F.regexp_replace(text, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", "$1$2")


def is_garbage(line: Column) -> Column:
    """A line of over 8 characters of which letters, digits and white space are under two fifths."""
    line = strip(line)
    kept = F.length(F.regexp_replace(line, r"[^\p{L}\p{N}\s]", ""))
    return (F.length(line) > 8) & (kept / F.length(line) < 0.4)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def clean_text(text: Column) -> Column:
    """Leading "_ " marks gone, broken words joined, garbage lines dropped."""
    text = dehyphenate(F.regexp_replace(text, r"(?m)^_ ", ""))
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~is_garbage(x)), "\n")


def is_decorative(page: Column) -> Column:
    """Under 8 words of ASCII letters, or under a fifth of them of 4 or more letters."""
    words = F.regexp_extract_all(page, F.lit("[A-Za-z]+"), F.lit(0))
    long = F.size(F.filter(words, lambda w: F.length(w) >= 4))
    return (F.size(words) < 8) | (long / F.greatest(F.size(words), F.lit(1)) < 0.2)


def has_native_text(page: Column) -> Column:
    return F.length(strip(page)) >= 80


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0)))


#: Running headers of scanned pages.
RUNNING_HEADERS = (
    r"Chapter\s+[0-9]+\s*[;:.\-]+\s*[A-Z][A-Z &\-]*\s*-?\s*",
    r"THE GREAT IDEAS\s*[0-9]*\s*",
    r"\s*[0-9]{1,4}\s*",
    r"PAC?G[BE]?\s*[0-9\s]*",
    r"\s*[0-9]+[a-zA-Z()0-9]*\s+to\s+[0-9]+[a-zA-Z()0-9]*\s+Chapter\s+[0-9]+\s*:?\s*",
    r"\s*[0-9]+[a-z]\s+to\s+[0-9]+[a-z]\s+[0-9]+\s*",
)


def is_running_header(line: Column) -> Column:
    found = F.lit(False)
    for pattern in RUNNING_HEADERS:
        found = found | line.rlike(f"^{pattern}$")
    return found


def strip_running_headers(text: Column) -> Column:
    """Header lines emptied, more than one blank line made one, ends trimmed."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.when(is_running_header(x), "").otherwise(x))
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


def strip_boilerplate(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?s)To find the passages cited.*?consult the Preface\.", ""))


def split_fused_headers(text: Column) -> Column:
    """A section header glued to the word before it gets a space."""
    return F.regexp_replace(text, r"([a-z.,;:!?])(OUTLINE OF TOPICS|CROSS-REFERENCES|ADDITIONAL READINGS)", "$1 $2")


# How scanning misreads the code of a subtopic, in the order of repair: pattern, replacement.
CODE_REPAIRS = (
    ("^S(?=[0-9])", "5"),
    ("^I(?=[0-9])", "1"),
    ("^O(?=[0-9])", "0"),
    ("^j(?=[0-9])", "7"),
    ("^l(?=[0-9])", "1"),
    (r"\(7$", "a"),
    (r"\^$", "b"),
    (r"\($", ""),
    ("/$", "f"),
    (r"\\$", "f"),
    ("([0-9])1-$", "$1b"),
    ("([0-9])I-$", "$1b"),
    ("-$", ""),
)


def fix_subtopic_code(line: Column) -> Column:
    """The code at the start of a line ("S2a.", "3^.", "2fl ") read aright."""
    line = F.regexp_replace(line, r"^(\s*[0-9]+[a-z]?)\s+\.\s", "$1. ")
    letter = F.regexp_extract(line, r"^\s*[0-9]+\s+([A-Z])\s+", 1)
    line = F.when(letter != "", F.concat(F.regexp_extract(line, r"^(\s*[0-9]+)\s+[A-Z]\s+", 1), F.lower(letter), F.lit(". "), F.regexp_replace(line, r"^\s*[0-9]+\s+[A-Z]\s+", ""))).otherwise(line)
    line = F.regexp_replace(line, r"^(\s*[0-9]+)f[li]\.?\s", "$1a. ")
    shape = r"^(\s*)(\S+?\.)(\s+.+)"
    code = F.regexp_replace(F.regexp_extract(line, shape, 2), r"\.+$", "")
    for pattern, right in CODE_REPAIRS:
        code = F.regexp_replace(code, pattern, right)
    whole = F.concat(F.regexp_extract(line, shape, 1), code, F.lit("."), F.regexp_extract(line, shape, 3))
    return F.when(line.rlike(shape), whole).otherwise(line)


def fix_outline_codes(text: Column) -> Column:
    """``fix_subtopic_code`` on the lines that begin with something like a code."""
    return F.array_join(F.transform(F.split(text, "\n"), lambda x: F.when(x.rlike(r"^\s*[0-9SIOjl]\S{0,4}\s*\.?\s"), fix_subtopic_code(x)).otherwise(x)), "\n")


def is_noise_line(line: Column) -> Column:
    """Page marks, scraps of at most 4 letters or digits, lines of punctuation; blank lines are none."""
    line = strip(line)
    return line.startswith("[PAGE ") | ((line != "") & (line.rlike(r"^[\p{L}\p{N}]{1,4}$") | line.rlike(r"^[^\p{L}\p{N}\s]+$")))


def squeeze(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"\s+", " "))


#: Names of ideas that scanning spoils.
IDEA_NAMES = {"CiOD": "GOD", "IMMORTALIl Y": "IMMORTALITY"}


def clean_idea_name(name: Column) -> Column:
    name = squeeze(name)
    table = F.create_map(*[F.lit(x) for pair in IDEA_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, name), F.regexp_replace(name, "^II+(?=ONOR)", "H"))


def title_case(text: Column) -> Column:
    """Every run of letters capitalised, after apostrophes and hyphens too."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0)), lambda x: F.concat(F.upper(F.substr(x, F.lit(1), F.lit(1))), F.lower(F.substr(x, F.lit(2))))), "")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(strip(text)), r"[^\p{L}\p{N}\s-]", ""), r"[\s-]+", "-")


def singular_slug(text: Column) -> Column:
    return F.regexp_replace(slug(text), r"s(?=-|$)", "")


def word_set(text: Column) -> Column:
    """A key that texts of the same words share, whatever their order, number of repeats and plural s."""
    words = F.transform(F.filter(F.split(F.lower(text), "[-& ]+"), lambda w: w != ""), lambda w: F.regexp_replace(w, "s$", ""))
    return F.array_join(F.array_sort(F.array_distinct(words)), "-")
