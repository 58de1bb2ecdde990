"""YAML settings and prompts are what their JSON form is."""

import json

import pytest

from quireflow import config
from quireflow.functions.plain_yaml import YamlError, loads

TEXT = '''---
# a file as settings files are
render:            # with a comment
  target_width: 1024
  image_format: "PNG"
  dims: [2048, 2560]  # in one line
tiling:
    overlap_ratio: 0.25

names:
- first
- 'it''s # no comment'
-   key: 1
    other: {a: 1, "b c": [x, 'y', 2.50], d: , e: null}
    deep:
      - - 1
        - 2
      -
        - 3
      - url: http://host:80/p#q
-
empty:
tilde: ~
quoted: "tab\\t \\u00e9 \\x41 \\"q\\" : # x"
"quoted key": yes
numbers: [0, -7, +3, 1_000, 0x1F, 017, 1.5, -.5, 2.0e+3, 1e3, 08, 1.2.3]
words: [true, False, ON, off, nO, yesno, Null, .inf]
many: [
  1,
  [2, 3],   # with a comment
  {k: v}
]
prompt: |
  first line: not a key
    - indented

  last # kept
strip: |-
  no break

keep: |+
  two breaks

folded: >
  one
  line

  next
    kept
  end
dated: 2024-01-02
-dash: x
last: a: b
'''


def test_yaml_is_its_json():
    got = loads(TEXT.replace("last: a: b\n", "last: a:b"))
    want = {
        "render": {"target_width": 1024, "image_format": "PNG", "dims": [2048, 2560]},
        "tiling": {"overlap_ratio": 0.25},
        "names": ["first", "it's # no comment", {"key": 1, "other": {"a": 1, "b c": ["x", "y", 2.5], "d": None, "e": None}, "deep": [[1, 2], [3], {"url": "http://host:80/p#q"}]}, None],
        "empty": None,
        "tilde": None,
        "quoted": 'tab\t é A "q" : # x',
        "quoted key": True,
        "numbers": [0, -7, 3, 1000, 31, 15, 1.5, -0.5, 2000.0, "1e3", "08", "1.2.3"],
        "words": [True, False, True, False, "nO", "yesno", None, float("inf")],
        "many": [1, [2, 3], {"k": "v"}],
        "prompt": "first line: not a key\n  - indented\n\nlast # kept\n",
        "strip": "no break",
        "keep": "two breaks\n\n",
        "folded": "one line\nnext\n  kept\nend\n",
        "dated": "2024-01-02",
        "-dash": "x",
        "last": "a:b",
    }
    assert got == want and json.dumps(got) == json.dumps(want)


@pytest.mark.parametrize(("text", "want"), [("", None), ("# nothing\n\n", None), ("x", "x"), ("[1, 2]", [1, 2]), ("- a\n- b: 1", ["a", {"b": 1}]), ("a:\n- 1\n- 2\nb: 3", {"a": [1, 2], "b": 3}), ("﻿a: |\n\n  x\n", {"a": "\nx\n"}), ("a: |2\n   x\n  y", {"a": " x\ny\n"}), ("a: ''", {"a": ""}), ("a: {}\nb: []", {"a": {}, "b": []})])
def test_small_files(text, want):
    assert loads(text) == want


@pytest.mark.parametrize("text", ["a: &x 1", "a: *x", "a: !int 1", "a: b: c", "a: [1, 2", "a: {x: 1", "a:\n  b: 1\n    c: 2", "a: 1\n  b: 2", "\ta: 1", "a: 'x", "  a: 1\nb: 2", "a: [1 2, [3]] x]", "a: 1\nplain"])
def test_what_is_not_in_the_subset(text):
    with pytest.raises(YamlError, match="line"):
        loads(text)


def test_settings_and_prompts_from_yaml(tmp_path):
    (tmp_path / "config.yml").write_text("render:\n  target_width: 1024\ntiling: {overlap_ratio: 0.25}\nsteps:\n  rotate: true\n")
    (tmp_path / "config.json").write_text('{"render": {"target_width": 1024}, "tiling": {"overlap_ratio": 0.25}, "steps": {"rotate": true}}')
    own = config.load_settings(str(tmp_path / "config.yml"), {"skip_ocr": True})
    assert own == config.load_settings(str(tmp_path / "config.json"), {"skip_ocr": True}) and own.render.target_width == 1024
    (tmp_path / "prompts.yaml").write_text("judge:\n  system: |\n    Look closely.\n  user: Answer.\n")
    assert config.load_prompts(str(tmp_path / "config.yml")) == {"judge": {"system": "Look closely.\n", "user": "Answer."}}
    (tmp_path / "empty.yaml").write_text("# nothing\n")
    assert config.load_settings(str(tmp_path / "empty.yaml")) == config.Settings()
