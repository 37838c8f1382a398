"""What the file of a public tokenizer says about itself."""

from __future__ import annotations

import json

# What a tokenizer's file must say for its texts to be encoded word by word; fixed values of
# the public vocabulary file.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


def splits_at_spaces(path: str) -> bool:
    """Whether the tokenizer's own file describes a pipeline in which no token, and no step
    before the tokens, reaches across ASCII white space."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    steps = (described.get("normalizer") or {}).get("normalizers")
    cuts = (described.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    model, added = described["model"], [t["content"] for t in described.get("added_tokens", [])]
    return (
        steps == _NORMALIZERS and cuts[0].get("type") == "Split" and cuts[0].get("pattern") == _PATTERN
        and (cuts[0].get("behavior"), cuts[0].get("invert")) == ("Removed", True) and cuts[1:2] != []
        and cuts[1].get("type") == "ByteLevel" and not cuts[1].get("add_prefix_space") and len(cuts) == 2
        and model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout")
        and not any(c.isspace() for a in added for c in a) and not any(described.get(k) for k in ("truncation", "padding"))
    )
