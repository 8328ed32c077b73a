"""Problem 6: replies that are no usable answer, with their type of defect.

Method: a pushdown parser follows reasoning blocks, fences, brackets, quotations, lists,
tables and emphasis and tells what breaks off; greedy string tiling measures how much of
a reply only repeats the question; scripts, function words and character models of the
languages of a corpus are compared; a refusal grammar knows how replies decline.  Every
reply is judged by itself beside its question.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import speech as models
from .fold import fold, plain

#: Replies that only hold a place.
_NOTHING = regex.compile(r"[\W_]*(?:null|none|nan|n/?a|n\.a\.|nil|tbd|todo|undefined|empty|no answer|n/d)[\W_]*", regex.IGNORECASE)
#: Replies that announce an answer and give none.
_INTRO_ONLY = regex.compile(r"[\W_]*(?:(?:the |my )?(?:final |correct |short )?(?:answer|result|response|reply|output)(?: is)?|antwort|respuesta|réponse)[\W_]*", regex.IGNORECASE)
_LETTER = regex.compile(r"[\p{L}\p{N}]")

# Words of grammar by language, without those that names and titles hold.
FUNCTION_WORDS = {
    "en": "is was were are be been has have had the it its this that these those there which who whom whose what where when by with at to as nor neither although since because before after between into than then so if not can cannot could would should must will do does did i we you he she they them their our my your his her same one other first only today answer question",
    "de": "der die das den dem des ein eine einen einem einer und ist war wird wurde sind nicht mit auf für von zu zum zur im am als auch nach bei aus wie es ich mir mich sie er wir hier dazu denn keine kein laut lautet beide richtige antwort darauf vermutlich haben hat sich werden dass oder über durch welcher welche wer",
    "fr": "le la les un une des du est et en dans que qui il elle ce cette ces se sont pour par sur pas ne je plus au aux avec sans selon été être à où nous vous leur son ses fut réponse agit faut donc quel quelle c'est qu'il d'après l'on",
    "es": "el la los las un una unos es en que se por para con del al fue era son según más como su sus no lo este esta está hay y o porque quién qué cuál respuesta trata muy ya ha han sin sobre creo datos pero desde",
    "it": "il lo la gli le un una è di che e in per con del della dei delle nel nella sono era fu si non più come questo questa secondo risposta giusta dovrebbe essere tratta stesso anche ma al alla dal i nello stesso",
    "pt": "o a os as um uma é em que e do da dos das no na nos nas com por para foi era são se não mais como seu sua acordo resposta trata deve ser mesma também ou pelo pela ao à os dados",
    "pl": "jest był była było to nie się na w z do że i od po przez oraz jako według danych chodzi o prawidłowa odpowiedź ponieważ razem pracowali dla ale czy który która roku",
    "tr": "bu ve bir için ile olan olarak göre doğru cevap kişi olmalı değil da de ne gibi daha çok sonra var yok verilere veya",
    "nl": "de het een en is was van in op te dat die niet met voor zijn aan er om ook als bij naar uit wordt werd antwoord volgens juiste",
    "sv": "och att det som en ett är var på med för av inte den till om han hon har från enligt svaret rätt",
}
#: Words that speak for no language, because names, titles and places hold them too.
_SILENT = frozenset("a an the of for from and notes la le de del da di do al el von van der den los las i o e y en no in un una les des du dos das".split())
_BY_WORD: dict[str, list[str]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in set(_words.split()) - _SILENT:
        _BY_WORD.setdefault(_w, []).append(_lang)
#: Letters that only one or two of the languages write.
_LETTERS = {"ß": ("de",), "¿": ("es",), "¡": ("es",), "ł": ("pl",), "ą": ("pl",), "ę": ("pl",), "ı": ("tr",), "ğ": ("tr",), "œ": ("fr",)}
_SCRIPTS = {"ru": regex.compile(r"\p{Cyrillic}{2,}"), "el": regex.compile(r"\p{Greek}{2,}"), "ja": regex.compile(r"[\p{Hiragana}\p{Katakana}]{2,}"), "zh": regex.compile(r"\p{Han}{3,}"), "ko": regex.compile(r"\p{Hangul}{2,}"), "ar": regex.compile(r"\p{Arabic}{2,}"), "he": regex.compile(r"\p{Hebrew}{2,}")}
_ELIDED = frozenset("l d c s n qu j".split())
_WORDS = regex.compile(r"[\p{L}\p{M}]+(?:['’][\p{L}\p{M}]+)?")

_ENGLISH = frozenset(FUNCTION_WORDS["en"].split()) | frozenset("the a an of for from and on about after before only also more most very own its his her".split())

# The refusal grammar, for case-folded text: who declines, the verb, and what it is about.
_REFUSAL = regex.compile(
    r"""\b(?:
      (?:can(?:not|['’]?t|\ not)|could\ not|couldn['’]t|unable\ to|not\ able\ to|(?:not\ possible|impossible)\ to)\ (?:be\ )?(?:reliably\ |safely\ |really\ )?(?:determin|answer|tell|identif|work\ out|help|deriv|provid|find|say\ (?!no\b)|know|infer|conclude|establish|decide|assist)
    | \b(?:i|we|nobody|no\ one|one)\ (?:am\ |are\ |is\ )?(?:can(?:not|['’]t)|could(?:\ not|n['’]t)|unable\ to|not\ able\ to)\ (?!say\ no\b)\w+ | (?:nobody|no\ one)\ (?:can|could)\ \w+ | it\ is\ (?:not\ possible|impossible)\ to\ \w+
    | (?:do|does|did)(?:\ not|n['’]t)\ (?:have|contain|mention|say|cover|provide|state|specify|include|give|allow|tell|suffice|reveal)
    | (?:do|does)(?:\ not|n['’]t)\ know(?=\s*(?:[.!?,;]|$)|\ (?:the|this|that|which|who|what|if|whether|enough|for))
    | (?:not\ enough|insufficient|no\ sufficient|lack\ of|too\ little)\ (?:context|information|data|facts|evidence|knowledge)
    | no\ (?:answer|conclusion)\ (?:can|could|is|was|has)
    | (?:holds?|contains?|gives?|have|has|there\ is|there\ are)\ no\ (?:such\ )?(?:fact|information|data|access|evidence|record|knowledge)
    | (?:must|have\ to|will)\ decline\b | decline\ to\ (?:answer|say|respond)
    | (?:rather|prefer)\ not\ (?:to\ )?(?:guess|answer|say)
    | as\ an?\ (?:ai|language\ model|artificial)
    | (?:is|are)\ not\ (?:given|mentioned|stated|specified|provided|known|described)\ (?:here|in\ the\ (?:context|facts|graph|triples|data|given|provided))
    | no\ idea\b | (?:sorry|apologi[sz]e),?\ (?:but\ )?i\b
    | kann\ (?:ich\ )?(?:\w+\ ){0,3}nicht\ (?:beantworten|sagen|bestimmen|ermitteln|helfen) | liegen\ (?:mir\ )?(?:\w+\ ){0,2}keine\b | weiss\ (?:ich|es)\ (?:\w+\ )?nicht | ich\ weiss\ (?:es\ |das\ )?nicht | (?:nicht\ genug|nicht\ genügend|keine\ ausreichenden)\ (?:daten|informationen|angaben) | lässt\ sich\ (?:\w+\ ){0,4}nicht
    | no\ hay\ (?:datos|información|suficiente) | no\ (?:puedo|es\ posible|se\ puede)\ (?:\w+\ )?(?:responder|contestar|saber|determinar|decir) | no\ (?:lo\ )?sé\b | no\ tengo\ (?:datos|información|suficiente) | no\ conozco\b | desconozco\b
    | ne\ (?:peux|puis|peut|sais|connais|dispose)\s?(?:pas|\b) | ne\ suffisent\ pas | ne\ permet(?:tent)?\ pas | (?:pas\ assez|aucune|pas\ suffisamment)\ (?:de\ |d['’])?(?:données|informations?|éléments|réponse) | je\ l['’]ignore
    | non\ (?:posso|so|è\ possibile|ho\ abbastanza|ci\ sono\ dati) | não\ (?:posso|sei|é\ possível|há\ dados|tenho)
    | nie\ (?:mogę|wiem|można|ma\ danych) | (?:bilmiyorum|cevap\ veremem|yeterli\ (?:bilgi|veri)\ yok) | не\ (?:могу|знаю|удалось)|недостаточно\ (?:данных|информации)|нет\ данных
    )""",
    regex.VERBOSE,
)
_UNABLE = r"(?:can(?:not|['’]?t)|could(?:n['’]t|\ not)|unable|not\ able|impossible|not\ possible|no\ way|(?:do|does|did|is|are|am|would|will)(?:n['’]t|\ not)|not|never|no|nothing|without|lack|lacks|fail|fails|hard|difficult)"
_TELL = r"(?:knows?(?=\s*(?:[.!?,;]|$)|\ (?:the|this|that|which|who|what|if|whether|enough|for|how|where|when|any|about)\b)|say(?=\s*(?:[.!?,;]|$)|\ (?:the|this|that|which|who|what|if|whether|for|with|how|where|when|any\w*)\b)|known|tell|answer|determine|identify|find|infer|conclude|confirm|verify|establish|help|assist|derive|decide|guess|share|disclose|discuss|speculate|respond|sure|certain|aware|familiar|comment|pinpoint|information|evidence|knowledge|data|facts|details|clue|idea|access|record)"
_SOURCE = r"(?:knowledge|information|context|data|facts?|evidence|graph|triples|sources?|passages?|text|material|details)"
#: Inability told by someone about telling something, in other words than those above.
_DECLINE = regex.compile(
    rf"""\b(?:
      (?:i|i['’]m|i['’]d|i['’]ve|we|we['’]re)\b[^.!?\n]{{0,30}}\b{_UNABLE}\b[^.!?\n]{{0,30}}\b{_TELL}\b
    | (?:there\ is|there['’]s|it\ is|it['’]s)\ (?:\w+\ ){{0,2}}(?:no\ way|not\ possible|impossible|hard|difficult|not\ clear|unclear)\ (?:for\ \w+\ )?(?:to|of|from)\b
    | (?:beyond|outside(?:\ of)?|exceeds|past)\ (?:\w+\ ){{0,3}}(?:knowledge|scope|abilit(?:y|ies)|expertise|training|reach|what\ i|what\ we)
    | (?:my|our|the\ (?:available|given|provided)|the|this|these|available|provided)\ (?:\w+\ )?{_SOURCE}\ (?:here\ )?(?:(?:do|does|is|are)(?:n['’]t|\ not)|fails?\ to|cannot|can['’]t|lacks?)\ (?:\w+\ ){{0,2}}(?:extend|tell|say|reveal|cover|include|contain|mention|support|suffice|sufficient|enough|help|answer|allow|permit|reach|hold)
    | (?:have\ to|must|will|going\ to|['’]ll|['’]d)\ (?:pass|abstain|skip|decline|refuse|refrain)\b(?!\ away)
    | (?:the\ )?answer\ (?:is|remains)\ (?:unknown|unclear|not\ (?:known|clear|available))\b
    | i\ (?:have|['’]ve\ got|hold)\ (?:no|nothing)\b
    | (?:unclear|not\ clear)\ from\ (?:the|these|this)\b
    | without\ (?:more|further|additional|any)\ {_SOURCE}
    )""",
    regex.VERBOSE,
)
_FIRST_PERSON = regex.compile(r"\b(?:i|we|my|our|i['’]m|i['’]d)\b|^(?:unclear|beyond|outside|without|there|it)\b|\b(?:knowledge|information|context|data|facts?|evidence|triples|graph|sources?)\b|answer")
#: Pieces of words without one of which nothing is a refusal.
_REFUSING = ("not", "n't", "n’t", "no ", "cant", "no one", "nobody", "unable", "impossible", "insufficient", "lack", "decline", "rather", "prefer", "language model", "as an a", "sorry", "apolog", "little", "beyond", "outside", "unclear", "unknown", "nothing", "without", "pass", "refus", "abstain", "hard", "difficult", "fail", "never", "kann", "keine", "weiß", "weiss", "lässt", "nicht", "hay", "puedo", "sé", "tengo", "conozco", "ne ", "aucune", "assez", "ignore", "non ", "não", "nie ", "bilmiyorum", "veremem", "yok", "не", "нет")
_DATA = regex.compile(r"^(?:insufficient|not enough|unknown|no information)\b[\w ]*[.!]?$", regex.IGNORECASE)


def declines(text: str) -> bool:
    """Whether a reply says that it gives no answer. A title in capital letters says nothing."""
    lower = text.casefold()
    if not any(w in lower for w in _REFUSING):
        return False
    if _REFUSAL.search(lower) or _DATA.match(text):
        return True
    words = _WORDS.findall(text)
    if len(words) <= 6 and all(w[0].isupper() or len(w) <= 3 for w in words):
        return False
    if _FIRST_PERSON.search(lower) is None:
        return False
    for m in _DECLINE.finditer(lower):
        # What is written as a title is one.
        told = [w for w in _WORDS.findall(text[m.start() : m.end()]) if len(w) > 1]
        if len(lower) != len(text) or text.isupper() or any(w[0].islower() for w in told):
            return True
    return False


_BLOCK = regex.compile(r"<\s*(/?)\s*(think|thinking|reasoning|scratchpad)\s*>", regex.IGNORECASE)
_BLOCKS = regex.compile(r"(?is)<\s*(think|thinking|reasoning|scratchpad)\s*>.*?<\s*/\s*\1\s*>")
_MARKUP = regex.compile(r"[*_`#~>]+|</?\w+\s*/?>")
_ENUMERATED = regex.compile(r"\((\d{1,2}|[a-h])\)\s*$")
#: Introductions whose rest is the answer.
_INTRO = regex.compile(
    r"^\s*(?:(?:so|hence|thus|therefore|finally)?[,:]?\s*(?:(?:the|my|our)\s+)?(?:final\s+|correct\s+|short\s+)?answer\s*(?:is|:)|(?:so\s+|thus\s+|hence\s+)?it\s+(?:is|was|must\s+(?:be|have\s+been))|that\s+(?:would\s+be|is|was|must\s+be)|(?:based\s+on|according\s+to|judging\s+by)\s+[^,]{3,40},\s*(?:it\s+(?:is|was)|the\s+(?:correct\s+)?answer\s+is)|hence\s*:|so\s*:|final\s+answer\s*:|answer\s*:|result\s*:)\s*",
    regex.IGNORECASE,
)
#: Openings before an answer.
_OPENING = regex.compile(r"^\s*(?:sure|certainly|of course|okay|ok|well|let us see|let's see|here is my reasoning|here is the answer|step by step|thanks|thank you|good question)\b\s*[.:,!]\s*", regex.IGNORECASE)
#: Words after which a sentence must go on.
_MUST_GO_ON = frozenset("of the a an and or by to in at with from for as that which who whose into between than is was were are be has have had nor but because since although before after on over under about namely not".split())
#: Words of sentences that names and titles without a full stop do not hold; the models of a corpus know more.
_SENTENCE = frozenset(FUNCTION_WORDS["en"].split()) - _SILENT - frozenset("one first other only her today answer question not cannot i".split()) | frozenset("can't don't doesn't didn't isn't wasn't".split())
_NAME_PARTS = frozenset("b d by trade retired former not".split())
#: Titles and parts of names that are commonly shortened; other short ones are known by their lack of vowels.
_SHORTENED = frozenset(("St", "Mt", "Ft", "Dr", "Mr", "Mrs", "Ms", "Jr", "Sr", "No", "Prof", "Gen", "Col", "Sen", "Rev", "Upr", "Vol", "Ave"))
_VOWEL = regex.compile(r"[aeiouyAEIOUY]")
_LAST_WORD = regex.compile(r"[\p{L}\p{N}]+$")
_ASKED = regex.compile(r"[?？]")
_ASIDE = regex.compile(r"\([^()]*\)")
_NUMBER = regex.compile(r"^\s*\d+\.\s*$")
_COMMA = regex.compile(r",\s*$")
_FIRST = regex.compile(r"\((?:1|a)\)")
_STOP = regex.compile(r"[.!?…。！？](?=[\s\"'”’»)\]*_]|$)")

_OPEN = {"(": ")", "[": "]", "{": "}", "“": "”", "„": "“”", "«": "»", "「": "」", "『": "』"}
_CLOSE = frozenset(")]}”»」』")
_MARK = regex.compile(r"[ \t]*(?:(\d{1,3})[.)]|([-*+•]))(?:[ \t]+|(?=\n|$))")
_EMPHASIS = ("**", "__", "~~")


def open_at_end(text: str) -> str | None:
    """What a pushdown parse of ``text`` leaves open, the outermost first: ``reasoning``, ``fence``, ``list`` (a mark
    of an item and no more), ``table`` (a row that does not end as the rows before it), a mark of emphasis, an opening
    bracket or quotation mark, or None."""
    stack: list[str] = []
    at, size, line, row = 0, len(text), True, False
    items = rows = 0
    while at < size:
        c = text[at]
        if stack and stack[-1] == "fence":
            if text.startswith("```", at):
                stack.pop()
                at += 3
                continue
        elif text.startswith("```", at):
            stack.append("fence")
            at += 3
            line = False
            continue
        elif c == "\n":
            # A line ends an item; a row of a table must have been closed before.
            if row and "table" in stack:
                del stack[stack.index("table") :]
            if "list" in stack and text[text.rfind("\n", 0, at) + 1 : at].strip():
                stack.remove("list")
            line, row = True, False
            at += 1
            continue
        elif line and (m := _MARK.match(text, at)):
            # Nothing opened inside an item reaches over to the next one but blocks and brackets.
            if "list" in stack:
                stack.remove("list")
            items += 1
            if not text[m.end() :].strip() and (items > 1 or text[:at].strip()):
                stack.insert(0, "list")
            at, line = m.end(), False
            continue
        elif line and c == "|":
            row, rows = True, rows + 1
            if rows > 1:
                stack.append("table")
            at, line = at + 1, False
            continue
        elif row and c == "|" and not text[at + 1 : (text.find("\n", at) + 1 or size + 1) - 1].strip():
            if "table" in stack:
                del stack[stack.index("table") :]
        elif c == "<":
            m = _BLOCK.match(text, at)
            if m:
                if not m[1]:
                    stack.append("reasoning")
                elif "reasoning" in stack:
                    # Nothing inside a closed block stays open.
                    del stack[stack.index("reasoning") :]
                at, line = m.end(), False
                continue
        elif c in "*_~" and text[at : at + 2] in _EMPHASIS:
            mark = text[at : at + 2]
            if mark in stack:
                del stack[stack.index(mark) :]
            elif text[at + 2 : at + 3].strip():
                stack.append(mark)
            at, line = at + 2, False
            continue
        elif c == '"':
            if '"' in stack:
                del stack[stack.index('"') :]
            else:
                stack.append('"')
        elif stack and c in _OPEN.get(stack[-1], ""):
            stack.pop()
        elif c in _OPEN:
            stack.append(c)
        elif c in _CLOSE and any(c in _OPEN.get(s, "") for s in stack):
            while c not in _OPEN.get(stack.pop(), ""):
                pass
        if not c.isspace():
            line = False
        at += 1
    return stack[0] if stack else None


def without_reasoning(text: str) -> str:
    """What is left of a reply without closed reasoning blocks."""
    return _BLOCKS.sub(" ", text)


def languages(text: str) -> dict[str, float]:
    """Evidence for each language in ``text``; a word that several languages share counts less."""
    found: dict[str, float] = {}
    latin = max(text, default="") < "\u0370"
    for name, pattern in () if latin else _SCRIPTS.items():
        n = len(pattern.findall(text))
        if n:
            found[name] = float(n)
    for word in {w.replace("’", "'") for w in _WORDS.findall(text.casefold())}:
        known = _BY_WORD.get(word)
        if known:
            for name in known:
                found[name] = found.get(name, 0.0) + 1 / len(known)
        if "'" in word and word.partition("'")[0] in _ELIDED:
            found["fr"] = found.get("fr", 0.0) + 0.7
    for c, names in () if text.isascii() else _LETTERS.items():
        if c in text:
            for name in names:
                found[name] = found.get(name, 0.0) + 0.5
    return found


@lru_cache(100_000)
def language_of_question(question: str) -> str:
    found = languages(plain(question))
    letters = len("".join(_WORDS.findall(question)))
    # Names in another script do not make a question one of that script.
    for name, pattern in _SCRIPTS.items():
        if name in found and len("".join(pattern.findall(question))) <= letters / 2:
            del found[name]
    return max(found, key=lambda n: (found[n], n == "en")) if found else "en"


#: Scripts that write words without blanks between them: their characters count as words.
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


def tokens(text: str) -> list[str]:
    """The folded words of ``text``; single characters where a script has no blanks."""
    return _UNSPACED.sub(r" \g<0> ", fold(text)).split()


class Automaton:
    """The suffix automaton of a question's tokens: all of its runs, in a size linear in its length."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for w in words:
            cur = self._state(self.length[last] + 1, {}, 0)
            p = last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                if self.length[q] == self.length[p] + 1:
                    self.link[cur] = q
                else:
                    copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
                    while p >= 0 and self.next[p].get(w) == q:
                        self.next[p][w] = copy
                        p = self.link[p]
                    self.link[q] = self.link[cur] = copy
            last = cur

    def _state(self, length: int, follow: dict[str, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def runs(self, words: list[str]) -> list[int]:
        """For each place of ``words``, the length of the longest run of the question that ends there."""
        out, at, n = [], 0, 0
        for w in words:
            while at and w not in self.next[at]:
                at = self.link[at]
                n = self.length[at]
            if w in self.next[at]:
                at, n = self.next[at][w], n + 1
            out.append(n)
        return out


@lru_cache(20_000)
def _question(question: str) -> tuple[tuple[str, ...], Automaton]:
    words = tokens(question)
    return tuple(words), Automaton(words)


def tiles(reply: list[str], question: Automaton, least: int = 2) -> list[bool]:
    """Which tokens of ``reply`` greedy string tiling covers with runs of the question: the longest runs first, each
    token of the reply once; the question may be repeated.  Linear but for sorting the runs by length."""
    ends = question.runs(reply)
    # Only runs that go no further to the right are the longest of their place.
    longest = [(n, i) for i, n in enumerate(ends) if n >= least and (i + 1 == len(ends) or ends[i + 1] != n + 1)]
    used = [False] * len(reply)
    for n, i in sorted(longest, key=lambda x: (-x[0], x[1])):
        first, last = i - n + 1, i
        # Longer tiles may have taken an end of this one; what they took from the middle they took whole.
        while first <= last and used[first]:
            first += 1
        while last >= first and used[last]:
            last -= 1
        if last - first + 1 >= least:
            used[first : last + 1] = [True] * (last - first + 1)
    return used


def _near(a: str, b: str) -> bool:
    """Whether two words differ by at most two letters."""
    if abs(len(a) - len(b)) > 2 or min(len(a), len(b)) < 3:
        return a == b
    return sum(1 for c in set(a) | set(b) if abs(a.count(c) - b.count(c))) <= 3 and (a[0] == b[0] or a[-1] == b[-1])


#: Words of grammar and courtesy that may stand around a repeated question.
_AROUND = frozenset("question you asked ask answer is the a an so your q was please tell me us thanks ok sure well hm again i do not this that of in for by whom who which what did it be to let and know briefly shortly short now".split())
#: What introduces a repeated question, up to a colon.
_INTRODUCED = regex.compile(r"^[^:?\n]{0,60}:\s+")


def copies(reply: str, question: str) -> bool:
    """Whether ``reply`` says no more than ``question``."""
    q, automaton = _question(question)
    if not q or len(reply) < 0.5 * len(question):
        return False
    r = tokens(reply)
    if len(q) < 4:
        # So few words are repeated as a whole or not at all.
        own = [t for t in r if t not in _AROUND or t in q]
        return bool(own) and len(own) % len(q) == 0 and all(tuple(own[i : i + len(q)]) == q for i in range(0, len(own), len(q)))
    known = set(q)
    if len(r) < 0.6 * len(q) or sum(t in known for t in r) < 0.5 * min(len(r), len(q)):
        return False
    covered = tiles(r, automaton)
    if sum(covered) < 0.6 * len(q):
        return False
    m = _INTRODUCED.match(reply)
    start = len(tokens(m[0])) if m else 0
    start = start if not any(covered[:start]) else 0
    close = lru_cache(None)(lambda t: any(_near(t, k) for k in known))
    loose = [t for t, c in zip(r[start:], covered[start:]) if not c and t not in _AROUND and not close(t)]
    last = max(i for i, c in enumerate(covered) if c)
    tail = tokens(_ASKED.split(reply)[-1]) if _ASKED.search(reply) else r[last + 1 :]
    # What follows the question is an answer, also where it is a name from the question.
    answered = any(t not in _AROUND for t in tail) and not (tail and not _ASKED.search(reply) and all(map(close, tail)))
    return len(loose) <= len(q) // 12 and not answered


def _sentences(text: str) -> tuple[list[str], str]:
    """Complete sentences, and what follows the last full stop."""
    done, start = [], 0
    for m in _STOP.finditer(text):
        before = text[start : m.start()]
        # Initials, abbreviations, dates and list numbers are no ends of sentences.
        word = _LAST_WORD.search(before)
        last = m.end() >= len(text.rstrip(" \"'”’»)]*_"))
        if m[0] == "." and word and not last and (len(word[0]) == 1 or word[0] in _SHORTENED or len(word[0]) <= 3 and word[0].istitle() and not _VOWEL.search(word[0][1:]) or (word[0].isdigit() and before[: word.start()].strip() == "")):
            continue
        done.append(text[start : m.end()])
        start = m.end()
    return done, text[start:].strip(" \"'”’»)]*_\t\r\n")


def _tells(words: list[str], speech: models.Speech | None) -> bool:
    """Whether any of the lower-case words speaks for a sentence."""
    return any(w in _SENTENCE or speech is not None and len(w) > 2 and w not in _SILENT and w not in _MUST_GO_ON and speech.speaks(w) for w in words if w not in _NAME_PARTS)


def _phrase(text: str, speech: models.Speech | None) -> bool:
    """Whether ``text`` may be a name or title: no word of a sentence, and no word that must go on at the end."""
    found = _WORDS.findall(text)
    words = [w.casefold().replace("’", "'") for w in found]
    if words and words[-1] in _MUST_GO_ON:
        return False
    if len(words) <= 4:
        return True
    running = [w for w, o in zip(words, found) if not o[0].isupper()]
    # Where no word is written as a name, or all are, words of grammar alone tell.
    return not (any(w in _SENTENCE for w in words if w not in _NAME_PARTS) or len(running) < len(words) and _tells(running, speech))


def breaks_off(text: str, speech: models.Speech | None = None) -> bool:
    """Whether a reply without its reasoning ends inside a bracket, a quotation, a list, a table, a sentence or a word."""
    left = open_at_end(text)
    if left in ("reasoning", "fence", "list", "table") or left in _EMPHASIS:
        return True
    words = _WORDS.findall(text)
    if left is not None and (left != '"' or len(words) > 4):
        return True
    m = _ENUMERATED.search(text.rstrip())
    if m and _FIRST.search(text[: m.start()]):
        return True
    clean = _ASIDE.sub(" ", _MARKUP.sub(" ", text))
    while _OPENING.match(clean):
        clean = _OPENING.sub("", clean, count=1)
    done, tail = _sentences(clean)
    if not tail:
        return False
    if _COMMA.search(clean) and len(words) > 5 and not _phrase(clean, speech):
        return True
    intro = _INTRO.match(tail)
    rest = tail[intro.end() :] if intro else tail
    told = languages(rest)
    if any(n != "en" and v > 1 for n, v in told.items()) and told.get("en", 0) < 1.5:
        return False
    if intro:
        inner = [w.casefold() for w in _WORDS.findall(rest)]
        return inner[-1:] != [] and (inner[-1] in _MUST_GO_ON or any(w in _SENTENCE for w in inner if w not in _NAME_PARTS and w != "them") or not _phrase(rest, speech))
    # A name after a complete sentence begins another one; list numbers are no sentences.
    before = [s for s in done if not _NUMBER.match(s)]
    return not _phrase(rest, speech) or bool(before) and bool(_WORDS.search(rest))


#: Scripts by name, and those that part words by blanks and tell capital letters from small ones.
_SCRIPT = {n: regex.compile(rf"\p{{{n}}}") for n in ("Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "Devanagari", "Bengali", "Gurmukhi", "Gujarati", "Tamil", "Telugu", "Kannada", "Malayalam", "Sinhala", "Thai", "Lao", "Khmer", "Myanmar", "Georgian", "Ethiopic", "Hangul", "Hiragana", "Katakana", "Han")}
_CASED = ("Latin", "Greek", "Cyrillic", "Armenian")
_FULL_STOP = regex.compile(r"[.!?。！？।॥؟։]\s*$")


def script_of(text: str) -> str | None:
    """The script of most letters of ``text``; Japanese is Han, whichever of its scripts it uses."""
    found: dict[str, int] = {}
    for name, pattern in _SCRIPT.items():
        n = len(pattern.findall(text))
        if n:
            name = "Han" if name in ("Hiragana", "Katakana") else name
            found[name] = found.get(name, 0) + n
    return max(found, key=lambda k: (found[k], k)) if found else None


def other_language(text: str, question: str, speech: models.Speech | None = None) -> bool:
    """Whether ``text`` is a sentence in another language than ``question``; names do not tell."""
    words = _WORDS.findall(text)
    script = "Latin" if text.isascii() else script_of(text)
    if script not in _CASED and script is not None and script != script_of(question):
        # Scripts without capital letters: several words, or many letters without blanks, or a full stop.
        letters = _SCRIPT[script].findall(text) if script != "Han" else _UNSPACED.findall(text)
        runs = [w for w in words if script_of(w) == script]
        unspaced = _UNSPACED.search(text) is not None and script != "Hangul"
        return len(letters) >= 12 and (len(runs) >= 4 or unspaced or len(runs) >= 3 and _FULL_STOP.search(text) is not None)
    asked = language_of_question(question)
    found = languages(text)
    known_words = set(_question(question)[0])
    running = [w for w in models.running(text) if len(w) > 1 and fold(w) not in known_words]
    if speech is not None and script == "Latin" and asked == "en" and len(running) >= 4 and len(running) < len(words) + (len(running) >= 6):
        known = sum(w.casefold() in _ENGLISH for w in running)
        if known <= 0.25 * len(running) and speech.strange(running, asked):
            return True
    if not found:
        return False
    best = max(found, key=lambda n: found[n])
    if best == asked or len(words) < 3:
        return False
    if best in _SCRIPTS:
        # A name in another script is no sentence, nor is one in lower case.
        told = _SCRIPTS[best].findall(text)
        low, most = sum(w[:1].islower() or not w[:1].isupper() for w in told), len("".join(told)) > 0.2 * len("".join(words))
        return most and (len(told) >= 3 and 1 <= low < len(told) or len(told) >= 5 and low >= 2 or len(told) >= 2 and low >= 1 and len(words) > len(told) and found.get(asked, 0) == 0)
    return found[best] >= 1.5 and found[best] > found.get(asked, 0.0)


def defect(reply: str | None, question: str, speech: models.Speech | None = None) -> str | None:
    """The defect of one reply to ``question``, or None."""
    if reply is None:
        return "empty"
    text = plain(reply)
    if "<" in text:
        if open_at_end(text) == "reasoning":
            return "truncated"
        text = without_reasoning(text)
    text = text.strip()
    bare = _MARKUP.sub(" ", text) if "<" in text or "*" in text else text
    if not _LETTER.search(bare) or len(bare) < 40 and (_NOTHING.fullmatch(text) or _INTRO_ONLY.fullmatch(bare)):
        return "empty"
    if copies(text, question):
        return "copies_question"
    if declines(text):
        return "refusal"
    # The repeated question tells nothing about the answer behind it.
    own = text.replace(plain(question), " ") if len(text) > len(question) else text
    if other_language(own, question, speech):
        return "other_language"
    return "truncated" if breaks_off(own, speech) else None


def defective_replies(prediction: DataFrame, split_record: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """Distinct ``(pred_id, defect)`` of the replies that are no usable answer.

    Defects: ``empty``, ``truncated``, ``refusal``, ``copies_question``,
    ``other_language``; the first that holds is reported, in the order of ``defect``.
    Replies without a record, and records without a question, are no case; a null reply
    to a question is empty.  Repeated records count once.  ``documents`` (``text, lang``)
    and the records' answers train the models of languages and sentences; without them
    only words of grammar tell.
    """
    questions = split_record.where("id is not null and question is not null").groupBy("id").agg(F.max("question").alias("question"))
    asked = prediction.where("pred_id is not null").select("pred_id", "id", "pred_answer").join(questions, "id").select("pred_id", "pred_answer", "question")
    kind = prediction.schema["pred_id"].dataType.simpleString()
    names = split_record.select("answer").where("answer is not null").distinct() if documents is not None and "answer" in split_record.columns else None
    trained = models.train(documents, names)
    shared = prediction.sparkSession.sparkContext.broadcast((trained.tables, trained.telling, trained.usual))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        speech = models.Speech(*shared.value)
        for pdf in batches:
            found = [defect(a, q, speech) for a, q in zip(pdf.pred_answer, pdf.question)]
            out = pd.DataFrame({"pred_id": pdf.pred_id, "defect": pd.Series(found, dtype="object")})
            yield out[out.defect.notna()]

    return asked.mapInPandas(judge, f"pred_id {kind}, defect string").distinct()
