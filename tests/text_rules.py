"""The text rules in plain Python, written from their description.

A second implementation to hold the Spark expressions against: whitespace by
``str.split``, digit grouping by walking the digits from the right, amounts by
a scanner that reads one character at a time.
"""

from posting_analytics import vocab


def one_space(text):
    """Words parted by single spaces; nothing for a missing text."""
    return " ".join((text or "").split())


def grouped(digits):
    """A run of digits without leading zeros, a dot before every third from the right."""
    significant = digits.lstrip("0") or "0"
    out = []
    for place, digit in enumerate(reversed(significant)):
        if place and place % 3 == 0:
            out.append(".")
        out.append(digit)
    return "".join(reversed(out))


def ascii_digits(text):
    return "".join(c for c in text if c in "0123456789")


def money(text):
    digits = ascii_digits(text)
    return vocab.MONEY_PREFIX + grouped(digits) if digits else text


class AmountScanner:
    """Reads amounts: an optional currency mark and spaces, digits and dots, a comma part."""

    def __init__(self, text, mark="", dot_first=True):
        self.text, self.mark, self.dot_first, self.at = text, mark, dot_first, 0

    def _run(self, allowed):
        start = self.at
        while self.at < len(self.text) and allowed(self.text[self.at]):
            self.at += 1
        return self.text[start:self.at]

    def _amount_here(self):
        start = self.at
        if self.mark:
            if self.text[start:start + len(self.mark)].lower() != self.mark:
                return None
            self.at += len(self.mark)
            self._run(str.isspace)
        body = self._run(lambda c: c == "." or c in "0123456789")
        if not body or (body[0] == "." and not self.dot_first):
            self.at = start
            return None
        if self.text[self.at:self.at + 1] == ",":
            comma = self.at
            self.at += 1
            fraction = self._run(lambda c: c in "0123456789")
            if fraction:
                return ascii_digits(body) + fraction
            self.at = comma
        return ascii_digits(body)

    def amounts(self):
        found = []
        while self.at < len(self.text):
            before = self.at
            amount = self._amount_here()
            if amount is None:
                self.at = before + 1
            else:
                found.append(amount)
        return found


def amount_range(found):
    """Smallest and largest of the amounts that are long enough, as money."""
    low = high = None
    for digits in found:
        if len(digits) < vocab.SALARY_MIN_DIGITS:
            continue
        size = int(digits)
        low = size if low is None or size < low else low
        high = size if high is None or size > high else high
    if low is None:
        return vocab.NOT_STATED
    ends = [str(low)] if low == high else [str(low), str(high)]
    return vocab.AMOUNT_RANGE_SEP.join(vocab.MONEY_PREFIX + grouped(e) for e in ends)


def listed_words(text, words, most=vocab.MAX_SKILLS):
    """The first words of the list that occur, whatever their case."""
    found, lowered = [], text.lower()
    for word in words:
        if len(found) == most:
            break
        if lowered.find(word.lower()) >= 0:
            found.append(word)
    return ", ".join(found) or vocab.NOT_FOUND


def first_rule(text, rules, otherwise=vocab.NOT_FOUND):
    """The label of the first rule whose keyword occurs."""
    lowered = text.lower()
    for keyword, label in rules:
        if lowered.find(keyword.lower()) >= 0:
            return label
    return otherwise
