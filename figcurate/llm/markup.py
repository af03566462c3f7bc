"""Clean text from HTML, JATS, Markdown, wiki and LaTeX leftovers by a linear-chain conditional random field.

A text is cut into leaves: plain runs, line breaks, and everything that could be markup (tags, entities, comments, marks, spans,
commands, single signs).  The leaves form a chain; open tags and environments are the ancestors of the leaves inside them.  The
field labels every leaf from features of its kind, its ancestors, its text, its neighbours, and the label before it:

=========  ===============================================================
PLAIN      text or a sign that belongs to the text; kept as it is
DROP       markup without content of its own; removed
INLINE     marks around content that stays
CHAR       an entity or escape that stands for a character
HEADING    a heading; becomes a line ``# ...``
ITEM       a list item; becomes a line ``- ...``
CODE       code; kept between back ticks or fences
FORMULA    a formula; kept between dollar signs
TABLE      a table row; cells are kept, separated by `` | ``
=========  ===============================================================

It is trained with gradient ascent on pages whose labels are known because they are written by ``labelled_pages``, and decoded
by Viterbi.  Texts without any sign that could be markup are one plain leaf and need no decoding.

Null stays null, empty stays empty.  A text holds markup if any of its leaves is not PLAIN.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from figcurate.session import spread

LABELS = ("PLAIN", "DROP", "INLINE", "CHAR", "HEADING", "ITEM", "CODE", "FORMULA", "TABLE")
PLAIN, DROP, INLINE, CHAR, HEADING, ITEM, CODE, FORMULA, TABLE = range(9)

_LEAF = re.compile(
    r"""
    (?P<comment><!--.*?-->|<!--|--> )
  | (?P<tag></?[A-Za-z][A-Za-z0-9:-]*(?:\s[^<>]*?)?\s*/?>)
  | (?P<broken></?[A-Za-z][A-Za-z0-9:-]*\s+[A-Za-z:-]+=(?:"[^"<>\n]*"?|'[^'<>\n]*'?|[^\s<>]*)|</[A-Za-z][A-Za-z0-9]*)
  | (?P<escaped>&(?:amp;)?lt;[!/]?[A-Za-z-][A-Za-z0-9:-]*(?:\s[^<>&]*?)?/?(?:--)?&(?:amp;)?gt;)
  | (?P<entity>&(?:\#[0-9]+|\#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]+);)
  | (?P<fence>```.*?(?:```|\Z))
  | (?P<tick>`[^`\n]+`)
  | (?P<head>^\#{1,6}[ ]+)
  | (?P<wikihead>^={2,6}[^=\n]+={2,6}[ ]*$)
  | (?P<setext>(?<=\n)[=-]{3,}[ ]*$)
  | (?P<wikitable>^\{\|.*?(?:^\|\}|\Z))
  | (?P<row>^\|.*\|[ ]*$)
  | (?P<bullet>^[ \t]*(?:[-+]|\*{1,3})[ ]+)
  | (?P<number>^[ \t]*[0-9]{1,3}[.)][ ]+)
  | (?P<quote>^>+[ ]?)
  | (?P<link>!?\[[^\]\n]*\]\([^)\n]*\))
  | (?P<wikilink>\[\[[^\]\n]*\]\])
  | (?P<template>\{\{[^{}]*\}\})
  | (?P<wikimark>'{2,5})
  | (?P<env>\\begin\{(?:equation|align|gather|math|displaymath|eqnarray|array|tabular|verbatim|lstlisting)\*?\}
      .*?(?:\\end\{[^}\n]*\}|\Z))
  | (?P<display>\\\[.*?\\\]|\\\(.*?\\\))
  | (?P<dollar>\$\$[^$]+\$\$|\$(?=\S)[^$\n]*?(?<=\S)\$(?![0-9]))
  | (?P<command>\\[A-Za-z]+\*?)
  | (?P<escape>\\[^A-Za-z\s])
  | (?P<strong>\*\*\*(?=[^\s*])[^*\n]*?(?<=\S)\*\*\*(?!\*)|\*\*(?=[^\s*])[^*\n]*?(?<=\S)\*\*|__(?=[^\s_])[^_\n]*?(?<=\S)__)
  | (?P<em>(?<![\w*])\*(?=[^\s*])[^*\n]*?(?<=\S)\*(?![\w*])|(?<![\w_])_(?=[^\s_])[^_\n]*?(?<=\S)_(?![\w_]))
  | (?P<strike>~~[^~\n]+~~)
  | (?P<newline>\n+)
  | (?P<sign>\*+|[<>&_$\#`~\\|{}^])
    """,
    re.X | re.S | re.M,
)
#: What a text must hold to have more than one leaf.
_ANY = r"[<>&*_$#`~\\|{}\[^\n]|''|^[ \t]*[-+] |^[ \t]*[0-9]{1,3}[.)] |^={2}[^\n]+=="

_VOID = frozenset("br hr img input meta link wbr col graphic inline-graphic".split())
_BLOCK = frozenset(
    "p div br hr li ul ol h1 h2 h3 h4 h5 h6 title sec caption fig fig-caption table tr td th pre blockquote section article "
    "label list list-item disp-formula abstract dl dt dd".split()
)
_HEAD_TAGS = frozenset("h1 h2 h3 h4 h5 h6 title".split())
_CODE_TAGS = frozenset("pre code tt samp kbd".split())
_MATH_TAGS = frozenset("math mml:math tex-math inline-formula disp-formula mi mo mn msub msup mrow mfrac".split())
_ITEM_TAGS = frozenset("li list-item dd dt".split())
_CELL_TAGS = frozenset("td th tr table".split())
#: Commands by what they do with their argument (fixed values); others are told apart by their shape only.
_COMMANDS = {
    name: kind
    for kind, names in {
        "content": "textbf textit emph underline text textrm textsc textsf texttt mbox mathrm mathbf mathit operatorname",
        "heading": "section subsection subsubsection paragraph chapter caption title",
        "reference": "cite citep citet ref eqref label footnote url includegraphics bibitem",
        "structure": "begin end item centering hline noindent maketitle",
        "symbol": "alpha beta gamma delta epsilon kappa lambda mu pi rho sigma tau omega pm times leq geq cdot degree",
        "maths": "frac dfrac tfrac sqrt binom sum prod int lim partial nabla infty hat bar vec dot tilde overline log exp ln sin cos",
        "second": "href textcolor colorbox",
    }.items()
    for name in names.split()
}
_HEADINGS = frozenset(f"\\{name}" for name, kind in _COMMANDS.items() if kind == "heading")
_GROUPS = {"head": _HEAD_TAGS | _HEADINGS, "code": _CODE_TAGS, "math": _MATH_TAGS, "item": _ITEM_TAGS, "cell": _CELL_TAGS}


@dataclass(slots=True)
class Leaf:
    """A piece of text; ``name`` is that of a tag or command, ``code`` tells the code element it lies in."""

    kind: str
    text: str
    start: int
    ancestor: str
    name: str = ""
    code: str = ""


def _name(text: str) -> tuple[str, bool, bool]:
    """Name of a tag, whether it closes, and whether it has no content."""
    bare = text.replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")
    m = re.match(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)", bare)
    name = m.group(2).lower() if m else ""
    return name, bool(m and m.group(1)), name in _VOID or bare.endswith("/>")


def _group(stack: list[str]) -> str:
    for name in reversed(stack):
        for group, names in _GROUPS.items():
            if name in names:
                return group
    return "other" if stack else ""


def _closing(text: str, at: int) -> int:
    """The end of the group that opens at ``at``, or -1 if it never closes."""
    depth = 0
    for m in _BRACE.finditer(text, at):
        depth += {"{": 1, "}": -1}.get(m.group(), 0)
        if not depth:
            return m.end()
    return -1


def _command(text: str, name: str, at: int) -> tuple[str, int]:
    """The kind and end of a command whose name ends at ``at``.

    Commands that mark up their last argument end with its opening brace (``open``); the argument is text like any other, and its
    closing brace is a leaf of its own.  Arguments of formulas and references are part of the command, and so are scripts.
    """
    kind = _COMMANDS.get(name, "other")
    if kind == "symbol":
        return "command", _scripts(text, at)
    if option := _OPTION.match(text, at):
        at = option.end()
    if kind in ("content", "heading", "other", "second"):
        if kind == "second" and text[at : at + 1] == "{" and (end := _closing(text, at)) > 0:
            at = end
        return ("open", at + 1) if text[at : at + 1] == "{" else ("command", at)
    while text[at : at + 1] == "{" and (end := _closing(text, at)) > 0:
        at = end
    if option := _OPTION.match(text, at):
        at = option.end()
    return "command", _scripts(text, at) if kind == "maths" else at


def _scripts(text: str, at: int) -> int:
    """The end of the sub- and superscripts that begin at ``at``."""
    while m := _SCRIPT.match(text, at):
        end = _closing(text, m.end() - 1) if m.group().endswith("{") else m.end()
        if end < 0:
            break
        at = end
    return at


_BRACE = re.compile(r"\\.|[{}]", re.S)
_OPTION = re.compile(r"\[[^\]\n]*\]")
_SCRIPT = re.compile(r"[_^](?:\{|\\[A-Za-z]+|[A-Za-z0-9])")


def leaves(text: str) -> list[Leaf]:
    """The chain of leaves; together they make up the text."""
    out: list[Leaf] = []
    stack: list[str] = []
    braces: list[str] = []  # the commands of open braces, empty for a brace without one
    line = ""  # what the mark at its beginning makes of the rest of a line
    at = 0

    def code() -> str:
        return "pre" if "pre" in stack else "code" if stack and not _CODE_TAGS.isdisjoint(stack) else ""

    def add(kind: str, start: int, end: int, name: str = "") -> None:
        group = _group(stack)
        out.append(Leaf(kind, text[start:end], start, line if line and group in ("", "other") else group, name, code()))

    def leave(name: str) -> None:
        if name in stack:
            del stack[len(stack) - 1 - stack[::-1].index(name) :]

    while m := _LEAF.search(text, at):
        start, end = m.span()
        if start > at:
            add("text", at, start)
        kind, value = m.lastgroup, m.group()
        if kind in ("tag", "escaped"):
            name, closes, void = _name(value)
            if closes:
                # a heading may be closed by the tag of another level
                other = next((x for x in reversed(stack) if x in _HEAD_TAGS), name) if name in _HEAD_TAGS else name
                leave(name if name in stack else other)
            add(kind, start, end, name)
            if not closes and not void:
                stack.append(name)
        elif kind == "command":
            name = value.strip("\\*")
            kind, end = _command(text, name, end)
            line = "" if name in ("item", "end") else line
            add(kind, start, end, name)
            line = "item" if name == "item" else line
            if kind == "open":
                braces.append(name)
                stack.append(f"\\{name}")
        elif value == "}" and braces:
            name = braces.pop()
            leave(f"\\{name}")
            add("close" if name else kind, start, end, name)
        else:
            if value == "{" and braces:
                braces.append("")
            line = "" if kind == "newline" else line
            add(kind, start, end)
            line = {"bullet": "item", "number": "item", "head": "head"}.get(kind, line)
        at = end
    if at < len(text):
        add("text", at, len(text))
    return out


def _class(char: str) -> str:
    if not char:
        return "edge"
    if char == "\n":
        return "line"
    if char.isspace():
        return "space"
    if char.isdigit():
        return "digit"
    if char.isalpha():
        return "letter"
    return char if char in "<>=*_$&([{.,;:" else "other"


_P_VALUE = re.compile(r"\s*[pP](?:\s|[<>=≤]|&[lg]t;)")
_WORDS = re.compile(r"[^\W\d_]{3,}")
_MATHS = re.compile(r"[\\^_={}<>]")


def _context(leaf: Leaf, before: str, after: str) -> tuple:
    """What the field sees of a leaf besides its neighbours; texts alike in it share their features."""
    text, kind = leaf.text, leaf.kind
    if kind == "text":
        n = len(text.split())
        shape = "blank" if not n else "short" if n <= 6 else "long"
        return (kind, shape, leaf.ancestor, text.rstrip()[-1:] == ".")
    if kind == "newline":
        return (kind, min(len(text), 2), leaf.ancestor)
    if kind == "tag":
        name, closes, _ = _name(text)
        known = "block" if name in _BLOCK else "math" if name in _MATH_TAGS else "code" if name in _CODE_TAGS else "inline"
        return (kind, known, closes, leaf.ancestor, " " in text)
    if kind == "sign":
        p = bool(_P_VALUE.match(after)) if text[0] == "*" else False
        return (kind, text, _class(before[-1:]), _class(after[:1]), p, leaf.ancestor)
    if kind in ("em", "strong", "strike", "dollar", "tick"):
        inner = text.strip("*_~$`")
        return (
            kind, text[0], bool(_P_VALUE.match(inner)), inner[:1].isdigit(), bool(_MATHS.search(inner)),
            min(len(_WORDS.findall(inner)), 2), " " in inner, _class(before[-1:]), _class(after[:1]),
        )
    if kind in ("command", "open", "close"):
        known = _COMMANDS.get(leaf.name, "other")
        scripted = known == "symbol" and ("_" in text or "^" in text)
        return (kind, "maths" if scripted else known, "{" in text, leaf.ancestor)
    if kind == "env":
        return (kind, re.match(r"\\begin\{(\w+)", text).group(1))
    if kind in ("bullet", "number", "quote"):
        return (kind, _class(before[-1:]), _class(after[:1]))
    return (kind, leaf.ancestor)


def _features(context: tuple, near: tuple[str, str, str, str]) -> list[str]:
    kind = context[0]
    out = [f"k={kind}", "c=" + "|".join(map(str, context))]
    out += [f"{kind}:{i}={v}" for i, v in enumerate(context[1:])]
    out += [f"{kind}:{where}={v}" for where, v in zip(("-1", "+1", "-2", "+2"), near, strict=True)]
    if kind == "text":
        out.append(f"text:{near[0]}:{context[1]}")
        out.append(f"text:{near[1]}:{near[3]}")
    return out


def chain(text: str) -> tuple[list[Leaf], list[tuple]]:
    """The leaves of a text and, for each, the key of its features."""
    found = leaves(text)
    kinds = ["", "", *(x.kind for x in found), "", ""]
    keys = []
    for i, leaf in enumerate(found):
        end = leaf.start + len(leaf.text)
        context = _context(leaf, text[max(0, leaf.start - 1) : leaf.start], text[end : end + 8])
        keys.append((context, (kinds[i + 1], kinds[i + 3], kinds[i], kinds[i + 4])))
    return found, keys


# ---------------------------------------------------------------------------------------------- labelled pages

_SENTENCES = (
    "Scale bar, 20 μm.|Red blood cells were counted at day 7 in treated mice.|Arrows mark the lesion of the left kidney.|"
    "Data are means ± SD of 6 wells; *P < 0.05, **P < 0.01.|The treated group (n>12) differed from controls (n<40).|"
    "Sections were stained with H&E and read by two observers.|Samples tbl_4_b and OD_600 values came from two donors.|"
    "A scan, which cost $48 to $132 per visit, was repeated [12].|Values where a<4 and b>7 were dropped [3, 14].|"
    "Median volume was x̄ = 4.5 cm³ for the drug (Fig. 3).|Levels of A12, B7/C4 and α-D9 fell by 12% [7].|"
    "*P < 0.05; ***P < 0.001 versus sham; NS, P = 0.2.|T2* maps at 7 T and run_12_a gave R&D at AT&T a p<0.05 result.|"
    "About 3 × 10⁵ cells were injected into the colon (n = 31).|Tracks from top to bottom, X1, Y22, Z3/W4 and κ-V5.|"
    "Mean price was $5, or <10% of $60, in s_1_c & s_2_d.|Green, ABC1; white, nuclei; ** marks P < 0.01 and * P < 0.05.|"
    "Comparison of MRI and CT for cysts of the spleen.|x < 3 and y > 5 hold for A|B pairs, ~20 per lane, #4 of 9."
).split("|")
_TITLES = "Figure 3|Methods|Study design|Zorbatin|Imaging of the knee|Results".split("|")


def labelled_pages(n: int, seed: int = 7) -> list[list[tuple[str, int]]]:
    """Pages as runs of text with their label; half of the pages hold one piece of markup or more."""
    r = random.Random(seed)
    sentences = [s for s in _SENTENCES if len(s) > 8]

    def plain(k: int = 1) -> str:
        return " ".join(r.choice(sentences) for _ in range(k))

    def word() -> str:
        return r.choice(("mild", "left lung", "of the", "ABC12", "in treated mice", "levels", "Tracks from", "a", "dose-response", "α-D9"))

    def tagged(name: str, inner: str, label: int = PLAIN) -> list[tuple[str, int]]:
        attributes = r.choice(("", "", ' class="x"', ' ref-type="bibr" rid="B7"', " id=f1"))
        return [(f"<{name}{attributes}>", DROP), (inner, label), (f"</{name}>", DROP)]

    def command(name: str, inner: list[tuple[str, int]]) -> list[tuple[str, int]]:
        return [(f"\\{name}{{", DROP), *inner, ("}", DROP)]

    def within(label: int) -> list[tuple[str, int]]:
        """A sentence under ``label`` that holds tags or commands."""
        words = r.choice(sentences).split(" ")
        cut = r.randint(1, len(words) - 1)
        left, right = " ".join(words[:cut]) + " ", " " + " ".join(words[cut:])
        marked = r.choice(
            (
                lambda: [(f"<{(t := r.choice(('b', 'i', 'sup', 'italic', 'bold', 'span')))}>", DROP), (word(), label), (f"</{t}>", DROP)],
                lambda: [(f"**{word()}**", INLINE)],
                lambda: [("\\emph{", DROP), (word(), label), ("}", DROP)],
                lambda: [(r.choice(("&lt;", "&nbsp;")), CHAR)],
            )
        )()
        return [(left, label), *marked, (right, label)]

    def inline() -> list[tuple[str, int]]:
        """A piece within a sentence."""
        w = word()
        var = r.choice("xyzkE")
        return r.choice(
            (
                lambda: tagged(r.choice(("b", "i", "sup", "sub", "italic", "bold", "xref", "span", "strong", "em", "a", "sc")), w),
                lambda: [(r.choice((f"<p class={w[:3].strip()}>", "<br/>", "<br>", '<graphic xlink:href="f1.jpg"/>')), DROP)],
                lambda: [(r.choice(('<xref rid="F1"', "<span class=cap", "</italic", "</p")), DROP), (r.choice((" ", "\n")), PLAIN)],
                lambda: [(f"&lt;{(t := r.choice(('i', 'b', 'sub', 'italic')))}&gt;", DROP), (w, PLAIN), (f"&lt;/{t}&gt;", DROP)],
                lambda: [(r.choice(("&nbsp;", "&amp;", "&lt;", "&gt;", "&#160;", "&#8804;", "&plusmn;", "&ensp;", "&#x3b1;", "&amp;lt;")), CHAR)],
                lambda: [(f"<!-- {r.choice(('layout 8', 'author query 4', 'fig size'))} -->", DROP)],
                lambda: [(r.choice(("<!--", "-->" + " ")), DROP)],
                lambda: [(f"{m}{w}{m}", INLINE) for m in [r.choice(("**", "***"))]],
                lambda: [("**", DROP), (f"{r.choice(('ABC12', 'levels'))}; *P <", PLAIN), ("**", DROP)],
                lambda: [("**", DROP), (r.choice(("mild", "Levels", "ABC")), PLAIN)],
                lambda: [(f"*{w}*", INLINE)],
                lambda: [(f"{m}{w}{m}", INLINE) for m in [r.choice(("_", "__"))]],
                lambda: [(f"~~{w}~~", INLINE)],
                lambda: [(f"`{w}`", CODE)],
                lambda: [(f"{r.choice(('', '!'))}[{w}](figs/{w[:3]}.png)", INLINE)],
                lambda: [(m := r.choice(("''", "'''")), DROP), (w, PLAIN), (m, DROP)],
                lambda: [(r.choice((f"[[{w}]]", f"[[target|{w}]]")), INLINE)],
                lambda: [(f"{{{{cite journal |title={w} |year=2020}}}}", DROP)],
                lambda: command(r.choice(("textbf", "emph", "textit", "underline", "text", "mathrm", "textsc")), [(w, PLAIN)]),
                lambda: command("".join(r.choice("abcdefgh") for _ in range(6)), [(w, PLAIN)]),
                lambda: command("textbf", [(w + " ", PLAIN), *command("emph", [(word() + " ", PLAIN), *command("textit", [(word(), PLAIN)])])]),
                lambda: command("href{http://x.org/a_b}", [(w, PLAIN)]),
                lambda: [(r.choice(("\\frac{a}{b}", f"\\sum_{{i=1}}^n {var}_i".split(" ")[0], "\\sqrt{x+1}", "\\alpha_{1}", "\\int_0^1", "\\frac{\\alpha}{1+k}")), FORMULA)],
                lambda: [(f"\\{r.choice(('cite', 'ref', 'label', 'citep', 'footnote'))}{{key7}}", DROP)],
                lambda: [("~", DROP), (f"\\{r.choice(('cite', 'ref'))}{{key7}}", DROP)],
                lambda: [(r.choice(("\\%", "\\&", "\\_", "\\$", "\\#", "\\,")), CHAR)],
                lambda: [(f"{r.randint(1, 99)}", PLAIN), ("\\,", CHAR), ("\\%", CHAR)],
                lambda: [(r.choice(("\\alpha", "\\pm", "\\mu", "\\times", "\\leq")), CHAR)],
                lambda: [
                    (r.choice((f"${var}<0.07$", f"$\\{r.choice(('alpha', 'beta'))}$", f"${var}_{{2}}$", f"${var}$", "$\\frac{a}{b}$", f"${var} = 5$", f"$${var}^2$$")), FORMULA)
                ],
                lambda: [(r.choice((f"\\[ {var} = k_{{5}} \\]", f"\\( {var} \\)")), FORMULA)],
                lambda: [
                    ("<math>", DROP), ("<mi>", DROP), (var, FORMULA), ("</mi>", DROP), ("<mo>", DROP), ("=", FORMULA), ("</mo>", DROP),
                    ("<mn>", DROP), ("7", FORMULA), ("</mn>", DROP), ("</math>", DROP),
                ],
                lambda: tagged(r.choice(("code", "tt")), w, CODE),
            )
        )()

    def block() -> list[tuple[str, int]]:
        title, body = r.choice(_TITLES), plain(r.randint(1, 2))
        mark = r.choice(("- ", "* ", "+ ", "1. ", "2) ", "** "))
        return r.choice(
            (
                lambda: [(f"{'#' * r.randint(1, 4)} ", DROP), (title, HEADING), ("\n\n", PLAIN), (body, PLAIN)],
                lambda: [(f"== {title} ==", HEADING), ("\n", PLAIN), (body, PLAIN)],
                lambda: [(title, HEADING), ("\n", PLAIN), (r.choice("=-") * len(title), DROP), ("\n\n", PLAIN), (body, PLAIN)],
                lambda: [*tagged(r.choice(("h2", "h3", "title")), title, HEADING), ("\n", PLAIN), *tagged("p", body)],
                lambda: [("<fig-caption>", DROP), *tagged("title", title, HEADING), *tagged("p", body), ("</fig-caption>", DROP)],
                lambda: [(body, PLAIN), ("\n\n", PLAIN), (mark, DROP), (plain(), ITEM), ("\n", PLAIN), (mark, DROP), (plain(), ITEM)],
                lambda: [("<ul>", DROP), ("<li>", DROP), ("P ", ITEM), ("&lt;", CHAR), (" 0.05 for n", ITEM), ("&gt;", CHAR), ("3", ITEM), ("</li>", DROP), ("</ul>", DROP)],
                lambda: [(mark, DROP), (plain(), ITEM), ("\n", PLAIN), (mark, DROP), (plain(), ITEM)],
                lambda: [(body, PLAIN), ("\n\n", PLAIN), (mark, DROP), *within(ITEM), ("\n", PLAIN), (mark, DROP), (plain(), ITEM)],
                lambda: [(mark, DROP), *within(ITEM), ("\n", PLAIN), (mark, DROP), (word(), ITEM), ("\n", PLAIN), (mark, DROP), *within(ITEM)],
                lambda: [("<ul>", DROP), ("<li>", DROP), *within(ITEM), ("</li>", DROP), ("\n", PLAIN), ("<li>", DROP), *within(ITEM), ("</li>", DROP), ("</ul>", DROP)],
                lambda: [(f"<{(t := r.choice(('h1', 'h3', 'title')))}>", DROP), *within(HEADING), (f"</{t}>", DROP), *tagged("p", body)],
                lambda: [("<ul>", DROP), *tagged("li", plain(), ITEM), *tagged("li", plain(), ITEM), ("</ul>", DROP)],
                lambda: [(body, PLAIN), ("\n\n", PLAIN), ("> ", DROP), (plain(), PLAIN)],
                lambda: [(body, PLAIN), ("\n", PLAIN), ("```\nfit <- model(a ~ b)\nprint(fit)\n```", CODE), ("\n", PLAIN), (plain(), PLAIN)],
                lambda: [(body, PLAIN), ("<pre>", DROP), ("x = 5", CODE), ("\n", PLAIN), ("if x ", CODE), ("&lt;", CHAR), (" 3: stop()", CODE), ("</pre>", DROP), *tagged("p", plain())],
                lambda: [("| marker | value |", TABLE), ("\n", PLAIN), ("|---|---:|", TABLE), ("\n", PLAIN), ("| ABC | 4 |", TABLE), ("\n\n", PLAIN), (body, PLAIN)],
                lambda: [('{| class="wikitable"\n! ABC !! dose\n|-\n| 4 || 5\n|}', TABLE), ("\n", PLAIN), (body, PLAIN)],
                lambda: [("<table>", DROP), ("<tr>", DROP), *tagged("td", "ABC", TABLE), *tagged("td", "4", TABLE), ("</tr>", DROP), ("</table>", DROP), (body, PLAIN)],
                lambda: [*command(r.choice(("section", "subsection", "paragraph", "caption")), [(title, HEADING)]), ("\n", PLAIN), (body, PLAIN)],
                lambda: [("<pre>", DROP), ("for x in rows:", CODE), ("\n", PLAIN), ("    total += x", CODE), ("\n", PLAIN), ("  if total ", CODE), ("&lt;", CHAR), (" 3:", CODE), ("\n", PLAIN), ("    stop()", CODE), ("</pre>", DROP)],
                lambda: [(body, PLAIN), ("\n", PLAIN), ("\\begin{verbatim}\nx <- 3\n  y\n\\end{verbatim}", CODE), ("\n", PLAIN), (plain(), PLAIN)],
                lambda: [("\\begin{tabular}{ll}\nA & 4 \\\\\nB & 5\n\\end{tabular}", TABLE), ("\n", PLAIN), (body, PLAIN)],
                lambda: [
                    (body, PLAIN), ("\n", PLAIN), ("\\begin{itemize}", DROP), ("\n", PLAIN), ("\\item", DROP), (" " + plain(), ITEM), ("\n", PLAIN),
                    ("\\item", DROP), (" " + plain(), ITEM), ("\n", PLAIN), ("\\end{itemize}", DROP),
                ],
                lambda: [(body, PLAIN), ("\n", PLAIN), ("\\begin{equation}\n R = \\frac{V}{K + s}\n\\end{equation}", FORMULA), ("\n", PLAIN), (plain(), PLAIN)],
                lambda: [("\\begin{figure}", DROP), ("\n", PLAIN), ("\\centering", DROP), ("\n", PLAIN), (body, PLAIN), ("\n", PLAIN), ("\\end{figure}", DROP)],
                lambda: tagged("p", body),
            )
        )()

    pages = []
    for _ in range(n):
        way = r.random()
        if way < 0.35:
            pages.append([(plain(r.randint(1, 4)), PLAIN)])
        elif way < 0.6:
            page = block()
            for _ in range(r.choice((0, 0, 1, 2))):
                page = [*page, (r.choice(("\n", "\n\n")), PLAIN), *block()]
            pages.append(page)
        else:
            page = []
            for _ in range(r.randint(1, 3)):
                words = plain(r.randint(1, 2)).split(" ")
                cut = r.randint(0, len(words))
                left, right = " ".join(words[:cut]), " ".join(words[cut:])
                piece = inline()
                gap = r.choice((" ", " ", " ", ""))
                page += [(left + (gap if left else ""), PLAIN), *piece, ((" " if right else "") + right + " ", PLAIN)]
            pages.append(page)
    return pages


def label_leaves(page: list[tuple[str, int]]) -> tuple[str, list[int]]:
    """The text of a page and the labels of its leaves: that of most of their characters (of a span, of its first)."""
    text = "".join(t for t, _ in page)
    labels = np.repeat([y for _, y in page], [len(t) for t, _ in page]) if text else np.zeros(0, dtype=int)
    out = []
    for leaf in leaves(text):
        own = labels[leaf.start : leaf.start + len(leaf.text)]
        out.append(int(np.bincount(own).argmax()) if leaf.kind == "text" else int(own[0]))
    return text, out


# ------------------------------------------------------------------------------------------------------- field


#: Leaves decoded at once, padding included.
CELLS = 1 << 17


class Field:
    """A linear-chain conditional random field over cached feature keys."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, steps: np.ndarray | None = None):
        self.weights = weights or {}
        self.steps = np.zeros((len(LABELS), len(LABELS))) if steps is None else steps
        self.cache: dict[tuple, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "steps": self.steps, "cache": {}}

    def emission(self, key: tuple) -> np.ndarray:
        found = self.cache.get(key)
        if found is None:
            if len(self.cache) > 200_000:
                self.cache.clear()
            found = np.zeros(len(LABELS))
            for name in _features(*key):
                if name in self.weights:
                    found = found + self.weights[name]
            self.cache[key] = found
        return found

    def decode(self, keys: list[list[tuple]]) -> list[np.ndarray]:
        """The best labels of each chain (Viterbi), many chains of similar length at a time."""
        out: list[np.ndarray] = [np.zeros(0, dtype=int)] * len(keys)
        order = sorted(range(len(keys)), key=lambda i: len(keys[i]))
        at = 0
        while at < len(order):
            # chains are sorted by length: as many as fill ``CELLS`` when padded to the longest of them
            size = 1
            while at + size < len(order) and size < 512 and (size + 1) * len(keys[order[at + size]]) <= CELLS:
                size += 1
            group = order[at : at + size]
            at += size
            lengths = np.array([len(keys[i]) for i in group])
            width = int(lengths.max(initial=0))
            if not width:
                continue
            scores = np.zeros((len(group), width, len(LABELS)))
            for row, i in enumerate(group):
                scores[row, : lengths[row]] = [self.emission(k) for k in keys[i]]
            best, back = scores[:, 0], np.zeros((len(group), width, len(LABELS)), dtype=np.int8)
            last = best.copy()
            for t in range(1, width):
                way = best[:, :, None] + self.steps[None]
                back[:, t] = way.argmax(1)
                best = way.max(1) + scores[:, t]
                last = np.where((lengths > t)[:, None], best, last)
            label = last.argmax(1)
            path = np.zeros((len(group), width), dtype=np.int8)
            for t in range(width - 1, -1, -1):
                path[:, t] = label
                step = back[np.arange(len(group)), t, label]
                label = np.where((lengths > t) & (t > 0), step, label)
            for row, i in enumerate(group):
                out[i] = path[row, : lengths[row]]
        return out


def train(pages: list[list[tuple[str, int]]], rounds: int = 60, rate: float = 0.25, penalty: float = 0.002) -> Field:
    """Maximise the penalised likelihood of the pages' labels with Adam; forward and backward passes over all chains at once."""
    chains, targets = [], []
    for page in pages:
        text, labels = label_leaves(page)
        _, keys = chain(text)
        if keys:
            chains.append(keys)
            targets.append(labels)
    names: dict[str, int] = {}
    n, width, size = len(chains), max(map(len, chains)), len(LABELS)
    rows, columns = [], []
    place = np.zeros((n, width), dtype=bool)
    truth = np.zeros((n, width), dtype=np.int64)
    for i, (keys, labels) in enumerate(zip(chains, targets, strict=True)):
        place[i, : len(keys)] = True
        truth[i, : len(keys)] = labels
        for t, key in enumerate(keys):
            for name in _features(*key):
                rows.append(i * width + t)
                columns.append(names.setdefault(name, len(names)))
    rows, columns = np.array(rows), np.array(columns)
    w, steps = np.zeros((len(names), size)), np.zeros((size, size))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(steps), np.zeros_like(steps)]
    gold = np.zeros((n * width, size))
    gold[np.arange(n * width), truth.reshape(-1)] = place.reshape(-1)
    gold_steps = np.zeros((size, size))
    both = place[:, 1:] & place[:, :-1]
    np.add.at(gold_steps, (truth[:, :-1][both], truth[:, 1:][both]), 1)

    def spread(values: np.ndarray, index: np.ndarray, total: int) -> np.ndarray:
        return np.stack([np.bincount(index, weights=values[:, k], minlength=total) for k in range(size)], axis=1)

    for k in range(1, rounds + 1):
        scores = spread(w[columns], rows, n * width).reshape(n, width, size)
        move = np.exp(steps)
        forward, backward = np.zeros_like(scores), np.ones_like(scores)
        local = np.exp(scores - scores.max(2, keepdims=True))
        forward[:, 0] = local[:, 0] / local[:, 0].sum(1, keepdims=True)
        for t in range(1, width):
            a = (forward[:, t - 1] @ move) * local[:, t]
            a /= a.sum(1, keepdims=True)
            forward[:, t] = np.where(place[:, t, None], a, forward[:, t - 1])
        expected_steps = np.zeros((size, size))
        for t in range(width - 2, -1, -1):
            ahead = local[:, t + 1] * backward[:, t + 1]
            b = ahead @ move.T
            b /= b.sum(1, keepdims=True)
            backward[:, t] = np.where(place[:, t + 1, None], b, 1.0)
            joint = forward[:, t, :, None] * move[None] * ahead[:, None]
            joint /= joint.sum((1, 2), keepdims=True)
            expected_steps += joint[place[:, t + 1]].sum(0)
        marginal = forward * backward
        marginal /= marginal.sum(2, keepdims=True)
        difference = gold - (marginal * place[:, :, None]).reshape(-1, size)
        gradients = (spread(difference[rows], columns, len(names)) / n - penalty * w, (gold_steps - expected_steps) / n - penalty * steps)
        for j, (value, gradient) in enumerate(zip((w, steps), gradients, strict=True)):
            first, second = moments[2 * j], moments[2 * j + 1]
            first += 0.1 * (gradient - first)
            second += 0.01 * (gradient**2 - second)
            value += rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return Field({name: w[c] for name, c in names.items() if np.abs(w[c]).max() > 1e-3}, steps)


@lru_cache(maxsize=2)
def default_field(pages: int = 700, seed: int = 7) -> Field:
    return train(labelled_pages(pages, seed))


# ------------------------------------------------------------------------------------------------------- output

_GREEK = dict(
    zip(
        "alpha beta gamma delta epsilon kappa lambda mu pi rho sigma tau omega pm times leq geq".split(),
        "α β γ δ ε κ λ μ π ρ σ τ ω ± × ≤ ≥".split(),
        strict=True,
    )
)


def _char(text: str) -> str:
    if text.startswith("&"):
        return html.unescape(html.unescape(text))
    bare = text[1:]
    return _GREEK.get(bare, " " if bare in ",;: " else bare if len(bare) == 1 else text)


def _inner(leaf: Leaf) -> str:
    """The content that a span keeps."""
    text = leaf.text
    if leaf.kind == "link":
        return re.match(r"!?\[([^\]]*)\]", text).group(1)
    if leaf.kind == "wikilink":
        return text[2:-2].rpartition("|")[2]
    if leaf.kind in ("command", "open"):
        return ""
    if leaf.kind == "wikihead":
        return text.strip().strip("=").strip()
    return text.strip("*_~`$")


def _table(text: str) -> str:
    if text.startswith("\\begin"):
        text = re.sub(r"^\\begin\{\w+\*?\}(?:\{[^}]*\})?|\\end\{\w+\*?\}$|\\[hct][a-z]*line", "", text)
        text = "\n".join(re.sub(r"\s*(?<!\\)&\s*", "|", row) for row in re.split(r"\s*\\\\\s*", text))
    lines = []
    for line in text.split("\n"):
        bare = line.strip()
        if bare.startswith(("{|", "|}", "|-", "|+")) or re.fullmatch(r"\|?[\s:|-]+\|?", bare):
            continue
        cells = [c.strip() for c in re.split(r"\|\||!!|\|", bare.strip("|!"))]
        lines.append(" | ".join(c for c in cells if c))
    return "\n".join(x for x in lines if x)


def _begins_anew(leaf: Leaf) -> bool:
    """Whether a dropped leaf ends the heading or item before it."""
    if leaf.kind in ("tag", "escaped", "broken"):
        return (leaf.name or _name(leaf.text)[0]) in _BLOCK
    if leaf.kind in ("open", "close", "command"):
        return _COMMANDS.get(leaf.name) in ("heading", "structure")
    return leaf.kind in ("bullet", "number", "quote", "head", "setext", "env", "fence")


class _Page:
    """Clean text under construction.  Code is held apart, so that white space in it stays as it is."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.held: list[str] = []
        self.code: list[str] = []
        self.mode = ""

    def hold(self, text: str) -> str:
        self.held.append(text)
        return f"\ue000{len(self.held) - 1}\ue001"

    def add(self, text: str) -> None:
        self.out.append(self.hold(text) if "\ue000" in text else text)

    def line(self, text: str) -> None:
        if self.out and not "".join(self.out[-2:]).endswith("\n"):
            self.out.append("\n")
        self.add(text)

    def keep(self, text: str) -> None:
        """Add text whose white space stays as it is."""
        self.out.append(self.hold(text))

    def block(self, text: str) -> None:
        self.line("")
        self.keep(text)
        self.out.append("\n")

    def end_code(self) -> None:
        body = "".join(self.code)
        if body.strip() and self.mode == "pre":
            self.block("```\n" + body.strip("\n").rstrip() + "\n```")
        elif body.strip():
            self.keep(f"`{body.strip()}`")
        self.code, self.mode = [], ""

    def text(self) -> str:
        self.end_code()
        text = re.sub(r"[ \t]+", " ", "".join(self.out))
        text = re.sub(r" ?\n ?", "\n", re.sub(r"\n{3,}", "\n\n", re.sub(r" *\n *", "\n", text))).strip()
        return re.sub("\ue000([0-9]+)\ue001", lambda m: self.held[int(m.group(1))], text)


def render(found: list[Leaf], labels: np.ndarray, field: Field) -> str:
    """The clean text of labelled leaves."""
    page = _Page()
    previous, fresh = None, True
    for leaf, label in zip(found, labels, strict=True):
        text = leaf.text
        if leaf.code:
            page.mode = leaf.code
            if not (leaf.kind in ("tag", "escaped", "comment") and label == DROP):
                page.code.append(_char(text) if leaf.kind in ("entity", "escape") and label == CHAR else text)
            continue
        if page.mode:
            page.end_code()
            previous = CODE
        same_run = previous == label and not fresh
        fresh = leaf.kind == "newline" or (label == DROP and _begins_anew(leaf))
        if label == PLAIN:
            if previous in (HEADING, ITEM, TABLE) and leaf.kind == "text" and text.strip():
                page.line("")
                text = text.lstrip()
            page.add(text)
        elif label == DROP:
            if _begins_anew(leaf) and page.out and not page.out[-1].endswith("\n"):
                page.add("\n")
        elif label == CHAR:
            page.add(_char(text))
        elif label == INLINE:
            page.add(clean(_inner(leaf), field))
        elif label == HEADING:
            inner = text if leaf.kind in ("text", "sign") else clean(_inner(leaf), field)
            page.add(inner) if same_run else page.line("# " + inner.lstrip())
        elif label == ITEM:
            own = _char(text) if leaf.kind in ("entity", "escape") else text
            page.add(own) if same_run else page.line("- " + own.lstrip())
        elif label == CODE:
            if leaf.kind == "fence":
                page.block(text)
            elif leaf.kind == "env":
                page.block("```\n" + re.sub(r"^\\begin\{\w+\*?\}\n?|\s*\\end\{\w+\*?\}$", "", text) + "\n```")
            elif leaf.kind == "tick":
                page.keep(text)
            elif text.strip():
                page.keep(f"`{text.strip()}`")
        elif label == FORMULA:
            body = re.sub(r"^\\begin\{\w+\*?\}|\\end\{\w+\*?\}$|^\\[\[(]|\\[\])]$", "", text).strip().strip("$").strip()
            if previous == FORMULA and page.out and page.out[-1].endswith("$") and leaf.kind == "text":
                page.out[-1] = page.out[-1][:-1] + " " + body + "$"
            elif body:
                page.add(f"${body}$")
        elif label == TABLE:
            row = _table(text) if leaf.kind != "text" else text.strip()
            if row:
                page.line(row) if leaf.kind != "text" or previous != TABLE else page.add(" | " + row)
        if label != DROP and not (label in (CHAR, INLINE) and previous in (HEADING, ITEM) and not fresh):
            previous = label
    return page.text()


def clean(text: str, field: Field) -> str:
    """Clean text; marks inside of marks are cleaned too, as deep as they go (each kind of mark excludes its own sign)."""
    found, keys = chain(text)
    labels = field.decode([keys])[0]
    return text if not labels.any() else render(found, labels, field)


def _label_batch(texts: pa.Array, field: Field) -> list[tuple[str | None, list[Leaf], np.ndarray]]:
    """For each text its leaves and labels; texts without a possible mark have neither."""
    texts = texts.cast(pa.string())
    some = np.asarray(pc.fill_null(pc.match_substring_regex(texts, "(?m)" + _ANY), False))
    values = texts.to_pylist()
    where = np.flatnonzero(some)
    chains = [chain(values[i]) for i in where]
    labels = field.decode([keys for _, keys in chains])
    out: list[tuple[str | None, list[Leaf], np.ndarray]] = [(v, [], np.zeros(0, dtype=int)) for v in values]
    for i, (found, _), label in zip(where, chains, labels, strict=True):
        out[i] = (values[i], found, label)
    return out


def with_markup(records: DataFrame, field: Field | None = None) -> DataFrame:
    """(record_id, text_field) where ``caption`` or an element of ``reference_texts`` holds markup; one pass, no shuffle.

    ``record_id`` is unique in ``records``.
    """
    model = field or default_field()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            caption = np.array([bool(y.any()) for _, _, y in _label_batch(batch.column(1), model)], dtype=bool)
            lists = batch.column(2)
            parent = np.asarray(pc.list_parent_indices(lists))
            hit = np.array([bool(y.any()) for _, _, y in _label_batch(pc.list_flatten(lists), model)], dtype=bool)
            references = np.unique(parent[hit]) if len(parent) else np.zeros(0, dtype=np.int64)
            own = np.flatnonzero(caption)
            names = ["caption"] * len(own) + ["reference_texts"] * len(references)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(np.concatenate([own, references]).astype(np.int64))), pa.array(names, type=pa.string())],
                names=["record_id", "text_field"],
            )

    columns = records.select("record_id", "caption", "reference_texts")
    return spread(columns).mapInArrow(run, "record_id bigint, text_field string")


def cleaned(items: DataFrame, field: Field | None = None) -> DataFrame:
    """(record_id, text_field, item, text, has_markup): every text in clean form; other texts unchanged."""
    model = field or default_field()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _label_batch(batch.column(3), model)
            marked = [bool(y.any()) for _, _, y in found]
            texts = [render(x, y, model) if m else v for (v, x, y), m in zip(found, marked, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(3)), pa.array(texts, type=pa.string()), pa.array(marked, type=pa.bool_())],
                names=["record_id", "text_field", "item", "text", "has_markup"],
            )

    schema = "record_id bigint, text_field string, item int, text string, has_markup boolean"
    return spread(items.select("record_id", "text_field", "item", "text")).mapInArrow(run, schema)
