"""Main text: custom elements, drawings, formulas and objects lose no text around or in them."""

import pytest

from tidemark.llm import main_text as M

LONG = "This sentence has a good many words, as the sentences of articles do, and it ends as they end."


@pytest.mark.parametrize("inner, want", [
    ("<svg-icon></svg-icon>", ""), ("<title-bar>bar</title-bar>", "bar"), ("<object-view>view</object-view>", "view"),
    ("<script-x>a</script-x>", "a"),
    ("<svg viewBox='0 0 1 1'/>", ""), ("<svg/>", ""), ("<svg/><b>kept</b><svg><text>x</text></svg>", "kept"),
    ("<svg><g><svg><text>x</text></svg></g><text>y</text></svg>", ""), ("<SVG\nid=a><title>t</title><text>x</text></SVG >", ""),
    ("<svg><path>", ""), ("<svg><svg><text>x</text></svg>kept", "kept"),
    ("<math/>", ""), ("<math><mi>x</mi><mo>=</mo><mn>1</mn></math>", "x=1"), ("<math><mi>x</mi>", "x"),
    ("<object data='a.pdf'>No viewer.</object>", "No viewer."), ("<object data='a.pdf'>No viewer.", "No viewer."),
    ("<script>x</script><style>x</style><title/>x</title>", ""),
])
def test_elements(inner, want):
    assert M.main_text(f"<article><p>{LONG}</p><p>{LONG} {inner}</p><p>{LONG}</p></article>") == " ".join(f"{LONG} {LONG} {want} {LONG}".split())


def test_very_many_open_drawings():
    assert M.main_text("<article>" + f"<svg><p>{LONG}</p>" * 5000 + "</article>").count(LONG) == 5000
