"""Engines that stand in for trained models."""

import re


class _Names:
    def mentions(self, text):
        return [(w, w.lower(), "PER") for w in re.findall(r"(?i)\bпетр\w*", text)]


class _Sentences:
    def split(self, text):
        return [(m.start(), m.end(), m[0].split()) for m in re.finditer(r"[^.]+\.?", text)]


def names():
    return _Names()


def sentences():
    return _Sentences()
