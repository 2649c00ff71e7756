"""The pattern catalogue, one place for every regular expression.

``P.java`` is the form for Spark (Unicode classes, new line alone ends a line), ``P.re`` the compiled Python form,
``P.re2`` the form for an SQL engine with RE2, ``P.scan`` the form that :mod:`.counts` counts by."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property


@dataclass(frozen=True)
class P:
    body: str
    flags: str = ""
    #: The body for RE2 over ASCII where matches are counted: the next match is looked for in the rest alone, so a match that ends in a word takes the rest of it.
    counted: str = ""

    @property
    def scan(self) -> str:
        return f"(?{self.flags})" + self.counted

    @property
    def java(self) -> str:
        return f"(?Ud{self.flags})" + self.body.replace(r"\Z", r"\z")

    @property
    def re2(self) -> str:
        return (f"(?{self.flags})" if self.flags else "") + self.body.replace(r"\×", "×")

    @cached_property
    def re(self) -> re.Pattern:
        return re.compile((f"(?{self.flags})" if self.flags else "") + self.body)


# Fixed values throughout: results depend on these patterns and word lists.
# What the quality cascade counts, headings.
NOISE = P(
    r"\[INS:[^\]]*\]|\[DEL:[^\]]*\]"
    r"|\b(cookie|advertisement|navbar|menu|sidebar|footer|header)\b"
    r"|\d{1,2}:\d{2}\s*(am|pm|AM|PM)|\bhttps?://\S+"
    r"|\b(click here|read more|subscribe|sign up|log in|register)\b"
    r"|\b(views?|likes?|shares?|comments?|followers?)\s*:\s*\d+",
    "i",
    r"\[INS:[^\]]*\]|\[DEL:[^\]]*\]"
    r"|\b(?:cookie|advertisement|navbar|menu|sidebar|footer|header)\b"
    r"|\d{1,2}:\d{2}[\t-\r ]*[ap]m(?:\w*[a-z_])?|\bhttps?://[^\t-\r ]+"
    r"|\b(?:click here|read more|subscribe|sign up|log in|register)\b"
    r"|\b(?:views?|likes?|shares?|comments?|followers?)[\t-\r ]*:[\t-\r ]*\d+(?:\w*[a-z_])?",
)
MATH = P(
    r"\$[^$]+\$|\$\$[\s\S]+?\$\$|\\[a-zA-Z]+"
    r"|\b(equation|theorem|proof|lemma|corollary|formula|integral|derivative|matrix|vector|polynomial|function|variable|coefficient|"
    r"calculate|compute|solve|simplify|evaluate|differentiate|integrate)\b"
    r"|\b\d+\s*[\+\-\*\/\^=]\s*\d+|\b(sin|cos|tan|log|ln|sqrt|lim|sum|prod)\b",
    "i",
    r"\$[^$]+\$|\$\$[\s\S]+?\$\$|\\[a-z]+\w*"
    r"|\b(?:equation|theorem|proof|lemma|corollary|formula|integral|derivative|matrix|vector|polynomial|function|variable|coefficient|"
    r"calculate|compute|solve|simplify|evaluate|differentiate|integrate)\b"
    r"|\b\d+[\t-\r ]*[\+\-\*\/\^=][\t-\r ]*\d+\w*|\b(?:sin|cos|tan|log|ln|sqrt|lim|sum|prod)\b",
)
HEADING = P(r"^(#{1,4})\s+(.+)$", "m")
# Cleaning.
NAV_LINE = P(
    r"^[\-\*\s]*(Facebook|Twitter|LinkedIn|Pinterest|Instagram|YouTube|Share [Tt]his( [Cc]ourse)?|Tweet|Home\s*[>»|/\\]"
    r"|Skip to (content|main|navigation)|You are here\s*:|Page\s+\d+\s+of\s+\d+|Print\s*(this)?\s*(page|article)?"
    r"|Subscribe\s*(now|today|free)?|Newsletter\s*Sign[\s\-]?[Uu]p|Follow [Uu]s\s*(on)?|Copyright\s*©?\s*\d{4}"
    r"|All [Rr]ights [Rr]eserved|Privacy [Pp]olicy|Terms of [Ss]ervice|Cookie [Pp]olicy)[^\n]*$",
    "m",
)
INS, DEL = P(r"\[INS:\s*(.*?)\s*:INS\]", "s"), P(r"\[DEL:.*?:DEL\]", "s")
INS_BARE, DEL_BARE = P(r"\[INS:\s*"), P(r"\[DEL:[^\]]*\]")
FORUM_META = P(
    r"^[ \t]*(Joined|Posts?|Thanks|Reputation|Location|Member since|Likes? received|Trophy points?|Gender|Online\s+Status"
    r"|Last [Ss]een|Registered|Messages?)\s*:[ \t]*.*$",
    "mi",
)
WRONG_HEADER = P(r"^(#{1,4})\s+(Incorrect [Aa]ttempts?|Wrong [Aa]nswers?|[Ee]rroneous [Ss]olutions?|[Ff]alse [Ss]olutions?|[Cc]ommon [Mm]istakes?)\s*$", "m")
WRONG_LABEL = P(
    r"(?:^|\n)[ \t]*(?:\d+\.|[-*])\s+\*{0,2}WRONG\*{0,2}\s*:"
    r"|(?:^|\n)[ \t]*\*{1,2}(?:WRONG|Incorrect|Wrong answer)\*{1,2}\s*:",
    "m",
)
LATEX_INLINE, LATEX_DISPLAY = P(r"\\\((.+?)\\\)", "s"), P(r"\\\[(.+?)\\\]", "s")
EXCESS_BLANK = P(r"\n{3,}")
# Classes by rule.
CALC_LINE = P(r"^\s*[\d,]+\s*[\+\-\×\*\/÷=]\s*[\d,]+\s*=\s*[\d,\.]+\s*$", "m")
UNIT_TABLE = P(
    r"(\d+\.?\d*\s+(inch|cm|kg|lb|mile|km|°[CF]|gallon|liter|foot|feet|yard|ounce|pound|meter|gram)\s*=\s*\d+\.?\d*\s+\w+\s*\n){3,}",
    "i",
)
NUMBER_LINE = P(r"^[\d\s\+\-\*\/=\.,\(\)]+$")
FORUM_STRONG = P(
    r"(Posted by\s+\w|Reply\s*#\d|Quote\s*:|^\s*(OP|bump)\b|Thread starter\s*:|Thread:\s+\w|<\s*blockquote|wrote\s*:\s*\n"
    r"|#\d+\s+\d{1,2}[-/]\w{2,3}[-/]\d{2,4}|\bMember\b.*\bPosts\b)",
    "im",
)
NUMBERED_SECTION = P(r"^\s*\d+\.\d+[\.\d]*\s+\w", "m")
FORMAL_BLOCK = P(r"^(Definition|Theorem|Lemma|Corollary|Proposition|Proof|Exercise|Remark)\s+\d+[\.\d]*", "mi")
PROB_MARK = P(r"^#{1,4}\s*(Problem|Question|Exercise|Task|Challenge)\b|^\*{1,2}(Problem|Question|Exercise)\*{1,2}\s*:", "mi")
SOL_MARK = P(r"^#{1,4}\s*(Solution|Answer|Worked [Ss]olution|Step[- ]by[- ]Step)\b|^\*{1,2}(Solution|Answer)\*{1,2}\s*:", "mi")
WORD_PROBLEM = P(r"\b(find|calculate|compute|solve|evaluate|determine|how many|how much|what is|prove that|show that|if .{5,50} then|given that)\b", "i")
DEFINITION = P(r"\b(definition|theorem|lemma|corollary|proposition|proof|remark|note)\b", "i")
# Headings of problems, solutions, examples, theorems.
PROB_HEADER = P(r"^(#{1,4})\s*(problem\s*(statement|description)?|question|exercise|task|challenge)\s*[\d\.\:]*\s*$", "mi")
SOL_HEADER = P(r"^(#{1,4})\s*(solution|answer|proof|workings?|derivation|solution\s*approach)\s*[\d\.\:]*\s*$", "mi")
PROB_HEADER_B = P(r"^(#{1,4})\s*(problem\s*(statement)?|question|exercise)\s*[\d\.\:]*\s*$", "mi")
SOL_HEADER_B = P(r"^(#{1,4})\s*(solution|answer|proof|workings?)\s*[\d\.\:]*\s*$", "mi")
EX_HEADER = P(r"^(#{1,4})\s*(example\s*[\d\.\:]*.*?)\s*$", "mi")
THM_HEADER = P(r"^(#{1,4})\s*(theorem|lemma|corollary|proposition)\s*[\d\.\:]*.*?$", "mi")
PRF_HEADER = P(r"^(#{1,4})\s*(proof|derivation)\s*[\d\.\:]*\s*$", "mi")
# Titles that ask or name a topic, mathematics in a text.
Q_TITLE_MATH = P(r"\$|\\[a-zA-Z]+|\^|_\{")
_VERBS = (
    r"find|prove|show|calculate|evaluate|solve|determine|compute|what\s+is|how\s+(many|much|do|to|can)|simplify|factori[sz]e|if\s+.+then|given\s+that"
    r"|derive|verify|express|expand|integrate|differentiate|rationali[sz]e|help|homework|urgently|questions?|problems?|solutions?|exercises?"
)
Q_TITLE_VERB = P(rf"\b({_VERBS})\b", "i")
_TOPICS = (
    r"algebra|calculus|geometry|trigonometry|statistics|probability|theorem|lemma|proof|equation|inequality|function|matrix|vector"
    r"|integral|derivative|limit|series|sequence|combinatorics|number\s+theory|polynomial|logarithm|exponential|complex\s+number|linear\s+algebra"
    r"|mechanics|physics|arithmetic|fraction|ratio|proportion|percentage|parabola|ellipse|circle|triangle|angle|quadratic|cubic|modular"
    r"|eigenvalue|eigenvector|fourier|laplace|differential|parametric"
)
MATH_TOPIC = P(rf"\b({_TOPICS})\b", "i")
MATH_TOPIC_D = P(rf"\b({_TOPICS}|mensuration|determinant|set\s+theory|factori[sz]ation|divisor)\b", "i")
MATH_IN_SOLUTION = P(r"\$|\\[a-zA-Z]+|\d+\s*[\+\-\*\/\^=]\s*\d+")
MATH_CONTENT = P(r"\$[^$]+\$|\$\$[\s\S]+?\$\$|\\[a-zA-Z]+|\d+\s*[\+\-\*\/\^=]\s*\d+")
# Forum posts.
META_LINE = P(
    r"^[\*_\s]*(Junior Member|Senior Member|Super Member|Newbie|Forum (Ph\.D\.|Freshman|Junior|Senior)|MHF (Contributor|Helper|Expert)|Administrator|Moderator|"
    r"Join(ed)?|Posts?:|Location:|From:|Awards?:|Thanks? (Received|Given):|Status:|Reputation:|Online|Offline|Default:).*$",
    "mi",
)
QUOTE_LINE = P(r"^>.*$", "m")
POST_NUMBER = P(r"^\*\*\s*(\d+)\s*[\.\)]\s*.*?#\s*\1\s*\*\*|^\*\*\s*(\d+)\s*[\.\)]\s*\*\*", "m")
THREAD_TITLE = P(r"\b(Thread|Discussion|Forum|Pre-University|Math Help)\b", "i")
# Bold labels, choices, steps and examples of textbooks.
BOLD_QUESTION = P(r"^\*\*(question|problem|exercise|task)\**\s*[\d\.\:]*\s*\*?\*?\s*[:：]?\s*(.+?)$", "mi")
BOLD_ANSWER = P(r"^\*\*(solution|answer|proof|hint)\**\s*[\d\.\:]*\s*\*?\*?\s*[:：]?\s*", "mi")
BOLD_LINE, BLANK_LINES, BOLD_CAPITAL = P(r"^\*\*", "m"), P(r"\n{2,}"), P(r"^\*\*[A-Z]", "m")
MCQ_ANSWER = P(r"(?:\*{0,2}Answer[\*:]{0,3}|Correct answer[\s\*:]+)\s*(.+?)(?=\n\n|\n#{1,4}|\Z)", "is")
OPTION = P(r"\n\s*[-\*]\s+\*{0,2}[A-D]\.")
MCQ_HINT = P(r"\*{0,2}Hint[\*\s:]+(.+?)(?=\n\n#{1,4}|\Z)", "is")
STEP_PROBLEM = P(r"\*{0,2}PROBLEM[\*:]{0,3}\s*\n([\s\S]*?)(?=\*{0,2}STEP|SOLUTION)", "i")
STEP_SOLUTION = P(r"\*{0,2}STEP-BY-STEP\s+SOLUTION[\*:]{0,3}\s*\n([\s\S]+?)(?=\n#{1,4}\s|\Z)", "i")
STEP_PROBLEM_LOOSE = P(r"\*{0,2}PROBLEM\*{0,2}[\s:\*]+(.+?)(?=\*{0,2}STEP|\*{0,2}SOLUTION)", "is")
STEP_SOLUTION_LOOSE = P(r"\*{0,2}(?:STEP-BY-STEP\s+)?SOLUTION\*{0,2}[\s:\*]+(.+?)(?=\n#{1,4}|\Z)", "is")
INLINE_EXAMPLE = P(r"^(?!#).*?(?:Example\s*\d*[\.\:])\s*(.+?)(?=\n\n(?!Example)|\Z)", "ms")
INLINE_SOLUTION = P(r"\A((?:\*{0,2}Solution[\*\s:]*|Step\s*\d+[\.\:]?).+?)(?=\n\n|\n#{1,4}|\Z)", "is")
# Pages of low value.
DIVISOR_PAGE = P(r"divisors of \d+|list of.*?positive divisors", "i")
ISBN = P(r"isbn[\s\-]*(?:10|13)?[\s\-:]", "i")
CONTENTS_PAGE = P(r"table of contents|chapter \d+.*\n.*chapter \d+", "is")
WORKED = P(r"example|solution|proof|theorem", "i")
UPLOADED = P(r"uploaded by|related interests", "i")
# Boxed answers and the places where a final answer stands.
BOXED, BOXED_FULL, BOXED_PLAIN = P(r"\\boxed\{[^}]*\}"), P(r"\\boxed\{(.+?)\}", "s"), P(r"\\boxed\{([^{}]*)\}")
CONCLUSION_INLINE = P(
    r"(?:thus|therefore|hence|so|consequently|we\s+get|we\s+have|we\s+obtain|the\s+(?:final\s+)?answer\s+is|is\s+equal\s+to|equals?|gives?\s+us"
    r"|result\s+is|value\s+is|solution\s+is)[^$\n]{0,60}\$([^$\n]{1,120})\$[.,;)!\s]*$",
    "mi",
)
EQUATION_INLINE = P(r"(?:thus|therefore|hence|so|consequently|we\s+get|the\s+answer\s+is)[^$\n]{0,40}\$\s*([a-zA-Z_]\s*=\s*[^$\n]{1,80})\$[.,;)!\s]*$", "mi")
DISPLAY_FINAL = P(r"\$\$\s*\n*\s*(?:=\s*)?([^\n$]{1,100})\s*\n*\s*\$\$\s*$", "s")
ANSWER_LABEL = P(r"(?:correct\s+)?[Aa]nswer\s*[:\-]\s*\$?\s*([A-Za-z0-9\+\-\\\{\}\s\^\_\(\)\/\.\,]{1,80}?)\$?\s*[.\n]?$", "m")
INLINE = P(r"\$([^$\n]{1,80})\$")
CONCLUSION_WORD = P(r"\b(thus|therefore|hence|so|answer|result|value|solution|equal|gives?)\b", "i")
BOXED_NOISE = P(r"\b(approximately|units?|meters?|cm|kg|seconds?|minutes?|hours?|See|Note|Since|where|which|this|that|Therefore|Thus|Hence)\b", "i")
# Gates.
LATEX_EXPR = P(r"\$[^$\n]+\$|\$\$[\s\S]+?\$\$")
CORE_MATH = P(
    r"\\(?:frac|sqrt|sum|int|prod|lim|infty|pm|times|div|alpha|beta|gamma|delta|theta|lambda|mu|pi|sigma|leq|geq|neq|approx|equiv|cdot|ldots|binom|vec|hat"
    r"|mathbb|mathbf|text|left|right|begin|end)\b"
)
ARITHMETIC = P(r"\d+\s*[\+\-\*\/\^=]\s*\d+")
GATE_NOISE = P(
    r"\b(see\s+also|references?|external\s+links?|further\s+reading|posted\s+by|comments?\s*:|reply\s*:|author\s*:|edited\s+by"
    r"|click\s+here|subscribe|newsletter|copyright|all\s+rights\s+reserved|privacy\s+policy|terms\s+of\s+service|cookies?)\b",
    "i",
)
URL, CODE_BLOCK = P(r"https?://\S+"), P(r"```[\w]*\n[\s\S]+?```")
DANGLING = P(r"^(it\b|this\b|these\b|those\b|the\s+above|the\s+following|as\s+shown|from\s+the\s+above|in\s+the\s+figure|see\s+figure|refer\s+to)", "i")
EXTERNAL_REF = P(r"\b(click\s+here|see\s+figure|as\s+shown\s+in|refer\s+to\s+the|in\s+the\s+diagram|from\s+the\s+graph|the\s+table\s+below)\b", "i")
TRUNCATED = (",", " the", " a", " of", " and", " or", " in", " to", " for", " is", " are", " be")
# Concept lessons.
CONCEPT_TITLE = ("lesson", "understanding", "how to", "guide", "ratio", "quart", "fraction", "equation", "graph", "trigonometric", "probability", "notation", "surface area", "distance between", "foi", "mixed numbers")
CONCEPT_BODY = ("objective", "big idea", "definition", "properties", "vocabulary", "examples", "how to", "understanding", "lesson")
CONCEPT_MARK = ("objective", "big idea", "definition", "example", "vocabulary", "properties", "strategy")
# Questions and units of route A.
EXPLICIT_QUESTION = tuple(P(x, "sm") for x in (r"### [^\n]*\n\n([^\n?]{8,220}\?)", r"\*\*Question:?\*\*\s*([^\n?]{8,220}\?)", r"\*\*Problem:?\*\*\s*([^\n?]{8,220}\?)", r"## Problem Statement.*?\n([^\n?]{8,220}\?)", r"^#\s+([^\n?]{8,220}\?)"))
ANSWER_LIKE = P(
    r"(=\s*[\d\.\-]+\s*$|\\frac\{[^}]+\}\{[^}]+\}\s*$|^\$.*\$\s*$|is\s+\$[^$]+\$[\w\s\./,]*$|cm\?$|kg\?$|m\?$|m/s\?$|s\?$|N\?$|J\?$|\\boxed\{"
    r"|is\s+-?[\d,]+(?:\.\d+)?\s*[.!]?\s*$|\*\*[\d][^*\n]{0,40}\*\*\s*[.!]?\s*$)",
    "i",
)
PROBLEM_UNIT = tuple(P(x, "s") for x in (r"(## Problem Statement.*?## Solution.*?)(?=\n## |\Z)", r"(## Interview Question.*?## Answer.*?)(?=\n## |\Z)", r"(### Problem.*?## Solution.*?)(?=\n## |\Z)", r"(\*\*Question:\*\*.*?(?:\*\*Answer:\*\*|## Solution).*?)(?=\n## |\Z)", r"(## Example.*?## Solution.*?)(?=\n## |\Z)"))
# Replies of a model.
LEAK_WORDS = ("instruction", "actual session", "request:", "source unit", "source excerpt", "assistant:", "user:")
ROLE_LINE = P(r"^(assistant|user|system|instruction|request|source unit|source excerpt|answer)\s*[:：].*$", "im")
SESSION_WORD = P(r"(actual session|prompt:|response:)", "i")
THINK, NEXT_Q, NEXT_PROBLEM = P(r"<think>.*?</think>", "s"), P(r"\n##\s+Q\b.*", "s"), P(r"\n#{1,3}\s+(Question|Problem|Exercise)\b.*", "is")
QUESTION_WITH_ANSWER = P(r"is\s+\$[^$]+\$[^?]*\?$")
LIST_MARK = P(r"^[\-\d\.\)\s]+")
# A final answer at the end of a text: pattern, where it looks (the text, its last six lines in one, its last line), what is trimmed off the end, least and most characters.
RESCUE = (
    (P(r"\$\$\s*([\s\S]+?)\s*\$\$\s*[.。]?\s*$"), "text", "", 1, 119),
    (P(r"=\s*\$?([^$=\n]{1,60}?)\$?\s*[.。]?\s*$"), "lines", ".。 ", 1, 49),
    (P(r"(?:is|are)\s+(-?[\d,]+(?:\.\d+)?(?:\s*/\s*[\d,]+)?)\s*[.。]?\s*$", "i"), "lines", ".。,", 1, 39),
    (P(r"\*\*([^*\n]{1,60})\*\*\s*[.。]?\s*$"), "lines", ".。", 1, 59),
    (P(r"\$([^$\n]{1,80})\$\s*[.。,]?\s*$"), "lines", "", 2, 79),
    (P(r"(?:answer|result|value)\s+(?:is|=)\s+\$?([^$\n.。]{1,50})", "i"), "lines", ".。", 1, 49),
    (P(r"(?<![a-zA-Z])(-?[\d,]+(?:\.\d+)?(?:\s*/\s*[\d,]+)?)\s*[.。]?\s*$"), "last", ".。,", 1, 29),
)
# Strategies of single classes.
NOT_TOPIC = P(r"\b(chapter|unit|module|part\s+\d|index|contents?|overview|syllabus)\b", "i")
LATEX_LOOSE = P(r"\$[^$]+\$|\$\$[\s\S]+?\$\$")
EXAMPLE_VERB_LOOSE, EXAMPLE_VERB = P(r"(find|prove|show|calculate|solve|evaluate|determine|compute)", "i"), P(r"\b(find|prove|show|calculate|solve|evaluate|determine|compute)\b", "i")
FORUM_ASKS = P(r"\b(find|prove|show|calculate|solve|determine|if|given)\b", "i")
LABEL_QUESTION_D = P(r"\*{1,2}(?:question|problem)\*{0,2}[\s\*:]+(.+?)(?=\*{1,2}(?:answer|solution)\*{0,2}[\s\*:]|\Z)", "is")
LABEL_ANSWER_D = P(r"\*{1,2}(?:answer|solution)\*{0,2}[\s\*:]+(.+?)(?=\n\n#{1,4}|\Z)", "is")
FORUM_QUESTION, FORUM_ANSWER = P(r"^\*\*Question\*\*\s*\n+(.+?)(?=\n\*\*Answer|\n---|\Z)", "ims"), P(r"^\*\*Answer[^*]*\*\*\s*\n+(.+)", "ims")
BOLD_USER = P(r"^\*\*([A-Za-z][\w\s\.]{1,40})\*\*\s*$", "m")
