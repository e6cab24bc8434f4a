"""Embedded and inline elements of pages."""

import pytest

from wardflow.llm import html_text


def text(source):
    return html_text.Page(source).text(())


@pytest.mark.parametrize("between", [
    '<svg class="i"/>', "<svg/>", "<math/>", "<video src=a>", '<audio src="a">', "<svg-icon>", "<video-player>", "<object-x></object-x>", "<title-card>",
    "<svg viewBox='0 0 1 1'><title>t</title><text>no</text></svg>", "<select><option>no<option>no</select>", "<object><p>no</p></object>", "<canvas>no</canvas>",
    "<video><video>no</video>no</video>", "<video src=a><video src=b>no</video>", '<svg hidden/><svg class="i">no</svg>'])
def test_text_after_embedded_elements_stays(between):
    assert text(f"<article><p>one</p>{between}<p>two</p></article><p>three</p>") == "one\ntwo\nthree"


def test_math_is_text_and_embedded_text_is_not():
    assert text("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>") == "so x=1 holds"
    assert text("<p>a <video>no <b>no</b></video>b<svg><text>no</text></svg> c</p>") == "a b c"
    assert text("<div><video><div>no</video> yes</div><p>two</p>") == "yes\ntwo"
    assert text("<script>no</script ><style/>no</style><p>a</p>") == "a"


@pytest.mark.parametrize("inline", [
    '<span class="ad">no <span>no</span></span>', '<a class="share" href="/x">no</a>', "<cookie-banner>no<p>no</p></cookie-banner>", "<button>no</button>",
    "<label>no</label>", '<a class=share href=/x/>no</a>', '<span class="ad"/>', '<span class="share">'])
def test_inline_parts_that_are_apart_are_left_out(inline):
    assert text(f"<article><p>one {inline}</p><p>two</p><p>three <b class='big'>four</b></p></article>") == "one\ntwo\nthree four"
