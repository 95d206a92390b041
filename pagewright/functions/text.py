"""Text rules of document export as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and character sets that exported documents must have.
NUMBERING = (
    r"^\s*((?:[1-9][0-9]*(?:\.[1-9][0-9]*)*[\.、]?"
    r"|[\(（](?:[1-9][0-9]*|[一二三四五六七八九十百千万亿零壹贰叁肆伍陆柒捌玖拾]+)[\)）]"
    r"|[一二三四五六七八九十百千万亿零壹贰叁肆伍陆柒捌玖拾]+[、\.]?"
    r"|(?:I|II|III|IV|V|VI|VII|VIII|IX|X)\.?))(\s*)(.*)$"
)
NON_BREAKING = (",", "，", "、", ";", "；", ":", "：", "-", "'", '"', "“")
# fixed values: prefix and size of the recogniser of a language or script
LANGUAGE_MODELS = {
    "uk": ("eslav_", "mobile"),
    "ru": ("eslav_", "mobile"),
    "be": ("eslav_", "mobile"),
    "en": ("en_", "mobile"),
    "ko": ("korean_", "mobile"),
    "el": ("el_", "mobile"),
    "th": ("th_", "mobile"),
    "latin": ("latin_", "mobile"),
    "cyrillic": ("cyrillic_", "mobile"),
    "ch": ("", "server"),
    "zh": ("", "server"),
}


def is_english_letter(c: Column) -> Column:
    return c.rlike(r"^[A-Za-z]$")


def is_numeric(c: Column) -> Column:
    return c.rlike(r"^[0-9]+$")


def is_non_breaking(c: Column) -> Column:
    """Punctuation after which a line of text goes on."""
    return c.isin(*NON_BREAKING)


def one_line(text: Column) -> Column:
    """Hyphenated line ends joined, other line ends as blanks."""
    return F.replace(F.replace(text, F.lit("-\n"), F.lit("")), F.lit("\n"), F.lit(" "))


def title(text: Column) -> Column:
    """A heading: numbering set off by one blank, trailing dots dropped, one "#" more than its depth."""
    numbering, rest = F.trim(F.regexp_extract(text, NUMBERING, 1)), F.ltrim(F.regexp_extract(text, NUMBERING, 3))
    spaced = F.when(text.rlike(NUMBERING), F.concat(numbering, F.lit(" "), rest)).otherwise(text)
    bare = F.rtrim(spaced, F.lit("."))
    depth = F.length(bare) - F.length(F.replace(bare, F.lit("."), F.lit(""))) + 1
    return one_line(F.concat(F.repeat(F.lit("#"), depth + 1), F.lit(" "), bare))


def centered(text: Column) -> Column:
    return F.concat(one_line(F.concat(F.lit('<div style="text-align: center;">'), text, F.lit("</div>"))), F.lit("\n"))


def image_path(label: Column, b: Column) -> Column:
    return F.format_string("imgs/img_in_%s_box_%d_%d_%d_%d.jpg", label, b.x1, b.y1, b.x2, b.y2)


def image_tag(path: Column, width: Column | None = None, page_width: Column | None = None) -> Column:
    """A markdown image, or with widths an HTML one scaled to its share of the page."""
    if width is None or page_width is None:
        return F.concat(F.lit("![]("), one_line(path), F.lit(")"))
    return F.format_string('<img src="%s" alt="Image" width="%d%%" />', one_line(path), F.floor(width / page_width * 100))


def chart_table(text: Column) -> Column:
    """Lines of cells as a markdown table, the first its header."""
    lines = F.split(text, "\n")
    rule = F.array_join(F.array_repeat(F.lit("---"), F.size(F.split(F.element_at(lines, 1), r"\|"))), "|")
    return F.array_join(F.transform(F.array_insert(lines, 2, rule), lambda line: F.concat(F.lit("|"), line, F.lit("|"))), "\n")


def table_body(html: Column) -> Column:
    """A table without the document around it."""
    for tag in ("<html>", "</html>", "<body>", "</body>"):
        html = F.replace(html, F.lit(tag), F.lit(""))
    return F.concat(F.lit("\n"), html)


def first_line_heading(text: Column, headings: tuple[str, ...], splitter: str = "\n", prefix: str = "## ", suffix: str = "") -> Column:
    """The first part that isn't blank becomes a heading if it is one of ``headings``."""
    lines = F.split(text, splitter)
    # place of the first line that isn't blank
    at = F.array_position(F.transform(lines, lambda line: F.trim(line) != ""), F.lit(True))
    return F.array_join(F.transform(lines, lambda line, i: F.when((i + 1 == at) & F.lower(line).isin(*headings), F.concat(F.lit(prefix), line, F.lit(suffix))).otherwise(line)), splitter)


def block_markdown(label: Column, content: Column, b: Column | None = None, page_width: Column | None = None, pretty: bool = False, charts: bool = False, seals: bool = False, tables: bool = True, formulas: bool = True) -> Column:
    """Markdown of a block by its label; null for labels that are left out (numbers, headers, footers, footnotes and the like).

    ``pretty``: titles of pictures, pictures (with ``page_width`` scaled to it) and tables as
    centred HTML.  What a switch leaves unrecognised (charts, seals, tables, formulas) is a
    picture.
    """
    path = image_path(label, b) if b is not None else F.lit("")
    plain = centered(content) if pretty else content
    picture = image_tag(path, b.x2 - b.x1, page_width) if pretty and page_width is not None and b is not None else image_tag(path)
    picture = centered(picture) if pretty else picture
    if tables:
        table = F.concat(F.lit("\n"), F.replace(plain, F.lit("<table>"), F.lit('<table border="1">'))) if pretty else table_body(F.concat(F.lit("\n"), content))
    else:
        table = picture
    paragraphs = F.replace(F.replace(content, F.lit("\n\n"), F.lit("\n")), F.lit("\n"), F.lit("\n\n"))
    return (
        F.when(label.isin("paragraph_title", "abstract_title", "reference_title", "content_title"), title(content))
        .when(label == "doc_title", one_line(F.concat(F.lit("# "), content)))
        .when(label.isin("table_title", "figure_title", "chart_title"), plain)
        .when(label.isin("text", "vision_footnote"), paragraphs)
        .when(label == "abstract", first_line_heading(content, ("摘要", "abstract"), " ", suffix="\n"))
        .when(label == "reference", first_line_heading(content, ("参考文献", "references")))
        .when(label == "content", F.replace(F.replace(content, F.lit("-\n"), F.lit("  \n")), F.lit("\n"), F.lit("  \n")))
        .when(label == "algorithm", F.regexp_replace(content, r"^\n+|\n+$", ""))
        .when(label == "image", picture)
        .when(label == "chart", chart_table(content) if charts else picture)
        .when(label == "seal", F.concat(picture, F.lit("\n"), plain) if seals else picture)
        .when(label == "formula", F.concat(F.lit("$$"), content, F.lit("$$")) if formulas else picture)
        .when(label == "table", table)
    )


def latin_runs_reversed(text: Column) -> Column:
    """Right-to-left text as read: characters in reverse, runs of Latin letters, digits and their signs kept."""
    return F.array_join(F.reverse(F.regexp_extract_all(text, F.lit(r"([a-zA-Z0-9 :*./%+-]+|[^a-zA-Z0-9 :*./%+-])"), F.lit(1))), "")


def word_runs(text: Column) -> Column:
    """Runs of Chinese characters, of letters and digits (with "-" and a decimal "." inside), and of other characters."""
    pattern = "([\\u4e00-\\u9fff]++|[a-zA-Z0-9][a-zA-Z0-9-]*+(?:\\.[0-9][a-zA-Z0-9-]*+)*+|[^a-zA-Z0-9\\u4e00-\\u9fff]++)"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def remove_cjk_text(latex: Column) -> Column:
    r"""``\text{...}`` around CJK characters is dropped, and straight quotes go."""
    return F.replace(F.regexp_replace(latex, "\\\\text\\s*\\{([^{}]*[\\u4e00-\\u9fff][^{}]*)\\}", "$1"), F.lit('"'), F.lit(""))


#: Commands whose argument holds words, written with a blank before the brace.
_WORDY = r"\\(?:operatorname|mathrm|text|mathbf)\s?\*? \{.*?\}"


def tighten_latex(latex: Column) -> Column:
    """LaTeX without the blanks that its tokens don't need.

    Runs of blanks count as one.  It goes between two characters that are no letters, and
    between such a one and an ASCII letter, unless it stands behind a backslash; blanks between
    letters stay.  That leaves nothing to a second round.  Arguments of commands for words lose all blanks.
    """
    found, rest = F.regexp_extract_all(latex, F.lit(f"({_WORDY})")), F.split(latex, _WORDY, -1)
    joined = F.concat(rest[0], F.array_join(F.transform(found, lambda m, i: F.concat(F.replace(m, F.lit(" "), F.lit("")), F.get(rest, i + 1))), ""))
    return F.regexp_replace(F.regexp_replace(joined, r"\s+", " "), r"(?<=[^\p{L}\\\s]) (?=[^\p{L}]|[a-zA-Z])|(?<=[a-zA-Z]) (?=[^\p{L}])", "")


def delimiter(label: Column) -> Column:
    """What stands between a block's lines."""
    return F.when(label == "doc_title", " ").when(label == "content", "\n").otherwise("")


def join_lines(lines: Column, label: Column) -> Column:
    """A block's text from its lines: hyphens at line ends go, letters meet with a blank, else the label's delimiter stands between."""
    sep = delimiter(label)

    def step(acc: Column, line: Column) -> Column:
        last = F.right(acc, F.lit(1))
        hyphened = F.when(last == "-", F.left(acc, F.length(acc) - 1)).otherwise(acc)
        glue = F.when(last == "-", "").when(sep != "", sep).when(last.rlike("[A-Za-z0-9,.;:]"), " ").otherwise("")
        return F.when(acc == "", line).otherwise(F.concat(hyphened, glue, line))

    return F.aggregate(lines, F.lit(""), step)


def model_of_language(lang: Column, family: str, default: str | None = None) -> Column:
    """Name of the recogniser of a family for a language, ``default`` for languages without one of their own."""
    known = F.create_map(*[F.lit(x) for k, (prefix, size) in LANGUAGE_MODELS.items() for x in (k, f"{prefix}{family}_{size}_rec")])
    return F.coalesce(known[lang], F.lit(default).cast("string"))


def eslav_name(lang: Column, name: Column) -> Column:
    """Recogniser name with the East Slavic prefix; other languages raise."""
    return F.when(lang.isin("ru", "uk", "be"), F.concat(F.lit("eslav_"), name)).otherwise(F.raise_error(F.lit("no recogniser for this language")).cast("string"))
