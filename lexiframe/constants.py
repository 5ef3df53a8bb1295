"""Fixed values. They are part of the data format and must stay exactly as written."""

# Characters that count as white space when text is stripped or collapsed.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
# The same set as a Java regular-expression class. The wide characters sit behind one range test,
# so that most characters are decided by the Latin part alone. The characters stand for themselves:
# Spark compares a pattern with the last one for each row, so a short pattern is a faster one.
_WIDE = "".join(char for char in WHITESPACE if char >= "\u0100")


_LATIN = "".join(char for char in WHITESPACE if char < "\u0100")
WS_CLASS = f"[{_LATIN}[\u1680-\u3000&&[{_WIDE}]]]"
NOT_WS = f"[^{WS_CLASS}]"
# Sequences that end a line, and the characters they are made of.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
LINE_BREAK_CHAR = r"[\n-\r\x1c-\x1e\x85\x{2028}\x{2029}]"
# Decimal digits of all scripts, and the ASCII digit each one stands for.
DIGITS = "".join(chr(c) for c in range(0x80, 0x20000) if chr(c).isdecimal())
ASCII_DIGITS = "".join(str(int(char)) for char in DIGITS)

# cp1252: what the bytes 80..9F mean, in byte order; a blank marks an undefined byte.
CP1252_HIGH = "€ ‚ƒ„…†‡ˆ‰Š‹Œ Ž  ‘’“”•–—˜™š›œ žŸ"
CP1252_UNDEFINED = "\x81\x8d\x8f\x90\x9d"

# HTML elements that never have content.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# HTML elements whose text is not part of the visible text around them.
HIDDEN_TEXT_TAGS = frozenset("rp rt script style template".split())
# HTML elements in which white space is kept as written.
PREFORMATTED_TAGS = frozenset("pre textarea".split())

# Labels of the metadata rows on a field page, and the column each one fills.
METADATA_LABELS = {
    "label": "label",
    "type": "type",
    "format": "format",
    "decimals": "decimals",
    "initial": "initial",
    "extent": "extent",
    "mandatory": "mandatory",
    "val exp": "val_exp",
    "val msg": "val_msg",
    "help": "help",
    "trigger": "trigger",
}
# Sections of a legacy column description, in order, and the column each one reads.
LEGACY_SECTIONS = [
    ("Description", "description"),
    ("Help", "help"),
    ("Content", "content"),
    ("Type", "field_type"),
    ("Format", "format"),
    ("Decimals", "decimals"),
    ("Initial", "initial"),
    ("Extent", "extent"),
    ("Mandatory", "mandatory"),
    ("Val Exp", "val_exp"),
    ("Val Msg", "val_msg"),
    ("Trigger", "trigger"),
    ("Indexes", "indexes"),
]
LEGACY_HEADING = "Legacy Data Dictionary Entries:"
MARKER_START = "<!-- legacy-data-dictionary-import:start -->"
MARKER_END = "<!-- legacy-data-dictionary-import:end -->"
OVERWRITE_PHRASE = "OVERWRITE OPENMETADATA CURATED METADATA"
ACTIVE_LIST_MARKER = "csd_active_source_tables"
DEFAULT_PREFIX = "csd_"

WRITE = "write"
SKIP_NOOP = "skip_noop"
SKIP_CONFLICT = "skip_conflict"
SKIP_NO_SOURCE = "skip_no_source"

FILL_EMPTY = "fill-empty"
APPEND_WITH_MARKER = "append-with-marker"
OVERWRITE = "overwrite"
FILL_DEFAULT = "fill-default"
