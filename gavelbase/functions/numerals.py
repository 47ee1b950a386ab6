"""Numbers as people write them: full-width digits, thousands separators, Chinese and formal (banking) numerals."""

from __future__ import annotations

import re

#: Fixed values.
DIGITS = {"零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9,
          "壹": 1, "贰": 2, "叁": 3, "肆": 4, "伍": 5, "陆": 6, "柒": 7, "捌": 8, "玖": 9}
SMALL = {"十": 10, "百": 100, "千": 1000, "拾": 10, "佰": 100, "仟": 1000}
LARGE = {"万": 10_000, "萬": 10_000, "亿": 100_000_000, "億": 100_000_000}
HAN = "".join(DIGITS) + "".join(SMALL)

_WIDE = {x: x - 0xFEE0 for x in range(0xFF01, 0xFF5F)} | {0x3000: 0x20}


def narrow(s: str) -> str:
    """Full-width forms as ASCII."""
    return s.translate(_WIDE)


def han_number(s: str) -> float | None:
    """The value of a Chinese numeral, positional (一二〇) or with units (一百二十, 壹万零伍拾), with 点 as the point; else None."""
    if not s:
        return None
    whole, _, part = s.partition("点")
    if part and not all(c in DIGITS for c in part):
        return None
    value = _whole(whole)
    if value is None:
        return None
    return value + (int("".join(str(DIGITS[c]) for c in part)) / 10 ** len(part) if part else 0)


def _whole(s: str) -> int | None:
    if not s:
        return None
    if all(c in DIGITS for c in s):
        return int("".join(str(DIGITS[c]) for c in s))
    total = section = digit = 0
    for c in s:
        if c in DIGITS:
            digit = DIGITS[c]
        elif c in SMALL:
            section += (digit or (1 if section == 0 else 0)) * SMALL[c]
            digit = 0
        elif c in LARGE:
            total = (total + section + digit) * LARGE[c] if LARGE[c] > 10_000 else total + (section + digit) * LARGE[c]
            section = digit = 0
        else:
            return None
    return total + section + digit


HAN_RUN = re.compile(f"[{HAN}]+")


def han_to_digits(s: str) -> str:
    """Each Chinese numeral in a text as Arabic digits."""
    return HAN_RUN.sub(lambda m: str(v) if (v := _whole(m.group())) is not None else m.group(), s)
