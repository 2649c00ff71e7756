"""Every pattern of the catalogue on literal texts: what it must find, and what not. Values are written out here, not taken from the code."""

import pytest
from pyspark.sql import functions as F

from lumenmill.functions import patterns as p
from lumenmill.functions import text as t

# name: (text, number of matches) ...
CASES = {
    "NOISE": [("menu: click here at 9:30 pm https://a.b/c likes: 12 [INS: x :INS]", 6), ("a plain line", 0), ("Cookie COOKIES 12:05 AM", 2)],
    "MATH": [(r"Solve $x^2$ and $$y$$ with \frac, 3 + 4 = 7, sin", 6), ("words alone", 0), ("MATRIX 12*3", 2)],
    "HEADING": [("# A\ntext\n#### D\n##### E\n#F", 2)],
    "NAV_LINE": [("Home > Docs\nShare This\nfine\n* Twitter\nPage 1 of 3\nshare it", 4), ("homework", 0)],
    "INS": [("a[INS: keep :INS]b", 1)],
    "DEL": [("a[DEL: x\ny :DEL]b", 1)],
    "INS_BARE": [("[INS: open", 1)],
    "DEL_BARE": [("[DEL: z]", 1)],
    "FORUM_META": [("Joined: 2009\n Posts: 12\nLast Seen: now\nI joined: no\nreputation : 3", 4)],
    "WRONG_HEADER": [("## Common Mistakes\nx\n### Wrong answers \n## common mistakes\n## Common mistaken", 3)],
    "WRONG_LABEL": [("1. WRONG: a\n- **WRONG**: b\n**Wrong answer**: c\n*Incorrect*: d\nWrong: e", 4)],
    "LATEX_INLINE": [(r"\(a\) and \(b" + "\n" + r"c\)", 2)],
    "LATEX_DISPLAY": [(r"\[a\] \[b\]", 2)],
    "EXCESS_BLANK": [("a\n\n\nb\n\nc\n\n\n\n\nd", 2)],
    "CALC_LINE": [("1 + 1 = 2\n 12 * 3 = 36 \n1 + 1\n7 ÷ 7 = 1", 3)],
    "UNIT_TABLE": [("1 inch = 2.54 cm \n2 inch = 5.08 cm \n3 inch = 7.62 cm \n", 1), ("1 inch = 2 cm \n", 0)],
    "NUMBER_LINE": [("1, 2.5 = (3)", 1), ("1 a", 0)],
    "FORUM_STRONG": [("Posted by anna\nReply #1\nQuote: x\nbump\nThread: y", 5), ("a quote", 0)],
    "NUMBERED_SECTION": [("1.1 Intro\n 2.3.4 More\n1. No\n3.1  X", 3)],
    "FORMAL_BLOCK": [("Theorem 1.1 abc\ndefinition 2\nProof. x\nExercise 3", 3)],
    "PROB_MARK": [("## Problem 1\n**Question**: x\n#### Task\n##### Task\nProblem", 3)],
    "SOL_MARK": [("# Solution\n## Step-by-step\n**Answer**: 4\nAnswer: 5", 3)],
    "WORD_PROBLEM": [("Find x, then show that if we take it all then how many are left", 4)],
    "DEFINITION": [("Definition and note of a theorem", 3)],
    "PROB_HEADER": [("## Problem 1:\n### Problem statement\n# Task\n## Problem of the day", 3)],
    "SOL_HEADER": [("## Solution\n# Workings\n### solution approach 2.\n## Solutions", 3)],
    "PROB_HEADER_B": [("## Question\n## Task", 1)],
    "SOL_HEADER_B": [("## Proof\n## Derivation", 1)],
    "EX_HEADER": [("## Example 2: find it\n### examples\n## An example", 2)],
    "THM_HEADER": [("## Theorem 4 of Thales\n### Lemma\n## A theorem", 2)],
    "PRF_HEADER": [("## Proof\n## Derivation 2\n## Proof of it", 2)],
    "Q_TITLE_MATH": [(r"a $ b ^ c _{ \alpha", 4), ("plain", 0)],
    "Q_TITLE_VERB": [("Find and factorise: homework problem", 4), ("finding", 0)],
    "MATH_TOPIC": [("Linear algebra and a triangle", 2), ("algebraic", 0)],
    "MATH_TOPIC_D": [("Mensuration of a circle", 2)],
    "MATH_IN_SOLUTION": [(r"costs 5$ or \pi or 3 + 4", 3)],
    "MATH_CONTENT": [(r"costs 5$ alone", 0), (r"$a$ and 3=4 and \pi", 3)],
    "META_LINE": [("Senior Member\nJoined 2009\nPosts: 3\nplain\n**Moderator**", 4)],
    "QUOTE_LINE": [("> said\nno\n>again", 2)],
    "POST_NUMBER": [("**1. first post #1**\n**2)**\n**3. x #4**\n**4. x #4**", 3)],
    "THREAD_TITLE": [("Math Help Forum Thread", 3)],
    "BOLD_QUESTION": [("**Question:** what is it\n**Task 2.** do it\nQuestion: no", 2)],
    "BOLD_ANSWER": [("**Answer:** 4\n**Hint** x\nAnswer", 2)],
    "BOLD_LINE": [("**a\nb **c\n**d", 2)],
    "BLANK_LINES": [("a\n\nb\nc\n\n\nd", 2)],
    "BOLD_CAPITAL": [("**A\n**b\n**C", 2)],
    "MCQ_ANSWER": [("**Answer:** B is right\n\nmore", 1)],
    "OPTION": [("Q\n- A. one\n* **B. two**\n- E. no", 2)],
    "MCQ_HINT": [("**Hint:** think", 1)],
    "STEP_PROBLEM": [("**PROBLEM:**\nadd\n**STEP-BY-STEP", 1)],
    "STEP_SOLUTION": [("**STEP-BY-STEP SOLUTION:**\nwe add", 1), ("SOLUTION\nx", 0)],
    "STEP_PROBLEM_LOOSE": [("PROBLEM: add them SOLUTION", 1)],
    "STEP_SOLUTION_LOOSE": [("Solution: we add", 1)],
    "INLINE_EXAMPLE": [("Take this. Example 3: add\n\nSolution", 1), ("# Example 3: add", 0)],
    "INLINE_SOLUTION": [("Solution: we add\n\nmore", 1), ("so the solution", 0)],
    "DIVISOR_PAGE": [("Divisors of 12", 1), ("list of all positive divisors", 1)],
    "ISBN": [("ISBN-13: 978", 1), ("isbns", 0)],
    "CONTENTS_PAGE": [("Chapter 1 a\nb\nchapter 2", 1), ("Table of Contents", 1)],
    "WORKED": [("An Example with proof", 2)],
    "UPLOADED": [("Uploaded by x", 1)],
    "BOXED": [(r"\boxed{1} \boxed{} \boxed{\frac{1}{2}}", 3)],
    "BOXED_FULL": [(r"\boxed{1}", 1)],
    "BOXED_PLAIN": [(r"\boxed{1} \boxed{\frac{1}{2}}", 1)],
    "CONCLUSION_INLINE": [("Thus, the answer is $7$.\nso it is\nhence $x$ is", 1)],
    "EQUATION_INLINE": [("Hence, $x = 5$", 1), ("x is $x = 5$", 0)],
    "DISPLAY_FINAL": [("a $$\n= 3\n$$ ", 1), ("$$3$$ end", 0)],
    "ANSWER_LABEL": [("Answer: 42\nanswer - x", 2)],
    "INLINE": [("$a$ b $c$", 2)],
    "CONCLUSION_WORD": [("so it gives a value", 3)],
    "BOXED_NOISE": [("Therefore 5 cm", 2)],
    "LATEX_EXPR": [("$a$ $$b$$", 2)],
    "CORE_MATH": [(r"\frac \sqrt \foo", 2)],
    "ARITHMETIC": [("3+4 and 5 / 6", 2)],
    "GATE_NOISE": [("See also: references, click here", 3)],
    "URL": [("http://a https://b ftp://c", 2)],
    "CODE_BLOCK": [("```py\nx\n``` ```\ny\n```", 2)],
    "DANGLING": [("This is", 1), ("Item one", 0), ("The above", 1)],
    "EXTERNAL_REF": [("as shown in the table below", 2)],
    "ANSWER_LIKE": [("it is x = 5", 1), (r"\boxed{", 1), ("5 kg?", 1), ("what now?", 0), ("it is 12.", 1)],
    "ROLE_LINE": [("User: hi\nanswer：x\nmy answer: y", 2)],
    "SESSION_WORD": [("Actual session Prompt: response:", 3)],
    "THINK": [("<think>a\nb</think>c", 1)],
    "NEXT_Q": [("a\n## Q2 x\nrest", 0), ("a\n## Q 2\nrest", 1)],
    "NEXT_PROBLEM": [("a\n### Question 2\nrest", 1), ("a\n#### Question 2", 0)],
    "QUESTION_WITH_ANSWER": [("what is $x$ now?", 1), ("is $x$ = 4.", 0)],
    "LIST_MARK": [("1) a", 1), ("a 1)", 0)],
    "NOT_TOPIC": [("Chapter on units, part 2", 2)],
    "LATEX_LOOSE": [("$a\nb$", 1)],
    "EXAMPLE_VERB_LOOSE": [("finding", 1)],
    "EXAMPLE_VERB": [("finding", 0), ("find it", 1)],
    "FORUM_ASKS": [("If given, prove", 3)],
    "LABEL_QUESTION_D": [("**Question** add **Answer** 4", 1)],
    "LABEL_ANSWER_D": [("**Answer** 4", 1), ("answer 4", 0)],
    "FORUM_QUESTION": [("**Question**\n\nadd\n**Answer", 1)],
    "FORUM_ANSWER": [("**Answer one**\n\nfour", 1)],
    "BOLD_USER": [("**anna b**\n**x:**", 1)],
}
TUPLES = {
    "EXPLICIT_QUESTION": ["### A\n\nWhat is a ratio of two?", "**Question:** What is a ratio?", "**Problem:** What is a ratio?", "## Problem Statement\nGiven\nWhat is a ratio?", "# What is a ratio?"],
    "PROBLEM_UNIT": ["## Problem Statement a ## Solution b", "## Interview Question a ## Answer b", "### Problem a ## Solution b", "**Question:** a **Answer:** b", "## Example a ## Solution b"],
    "RESCUE": ["so $$ x = 5 $$", "so x = 5.", "it is 133,320.", "makes **9.8 m/s**.", "we get $ab$.", "answer is blue or so", "in all 12"],
}


def test_every_pattern_has_literal_cases():
    named = {k for k, v in vars(p).items() if isinstance(v, p.P)}
    assert named == set(CASES) and {k for k, v in vars(p).items() if isinstance(v, tuple) and v and (isinstance(v[0], p.P) or isinstance(v[0], tuple))} == set(TUPLES)


def test_counts_in_python_and_spark(spark):
    rows = [(name, text, n) for name, cases in CASES.items() for text, n in cases]
    for name, text, n in rows:
        assert len(list(getattr(p, name).re.finditer(text))) == n, (name, text)
    df = spark.createDataFrame([(x,) for _, x, _ in rows], "x string")
    got = df.select("x", *(t.count(F.col("x"), getattr(p, name)).alias(name) for name in CASES)).collect()
    by = {r["x"]: r for r in got}
    assert [(name, text, by[text][name]) for name, text, _ in rows] == rows


@pytest.mark.parametrize("name", sorted(TUPLES))
def test_listed_patterns(name):
    for q, text in zip(getattr(p, name), TUPLES[name], strict=True):
        assert (q[0] if isinstance(q, tuple) else q).re.search(text), text
