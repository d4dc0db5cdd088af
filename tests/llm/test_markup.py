"""Legal markup that must not hide the text after it."""
import pytest

from fareforge.llm.extract import leaf_blocks


@pytest.mark.parametrize("page, texts", [
    ("<p>a <svg-icon name=x></svg-icon> b<p>c", ["a", "b", "c"]),
    ("<title-bar>a</title-bar><object-view>b</object-view><p>c", ["a", "b", "c"]),
    ("<p>a <svg viewBox='0 / 1'/> b<p>c", ["a b", "c"]),
    ("<p>a <svg><path d='m'/>no</svg> b<p>c", ["a b", "c"]),
    ("<html><head><meta charset=utf-8><title>t</title><link rel=x><body><p>a<p>b", ["a", "b"]),
    ("<html><head><title>t</title><script>no</script><h1>a</h1><p>b", ["a", "b"]),
    ("<head><title>t</title>\n a <b>b</b><p>c", ["a b", "c"]),
    ("<head><title>t</title><svg/><p>a", ["a"]),
    ("<html><head><title>t</title><style>no</style></head><body><p>a", ["a"]),
    ("<script>no</script><object data=x>no</object><iframe>no</iframe>a", ["a"]),
])
def test_text_after_unseen_elements(page, texts):
    blocks = leaf_blocks(page)
    assert [b.text for b in blocks] == texts
    assert not any(name == "head" for b in blocks for name, _ in b.path)
