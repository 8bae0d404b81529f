from pulsegrid.llm import pages


def site(prose, articles, body):
    """Pages of one host from `body`, a format of title, text, rows and number."""
    rows = lambda i: "".join(f"<li><b>{prose(4, 900 + 10 * i + k)}</b><i>Read more</i></li>" for k in range(2 + i % 3))
    return ["<html><body><nav><ul><li>Home<li>News</ul></nav>" + body.format(title=prose(5, i), text=prose(40, 100 + i), rows=rows(i), i=i) + "</body></html>" for i in articles]


def test_template_decides_inside_the_article(prose):
    body = "<article><h1>{title}</h1><p>Read this on our phone app.</p><div>{text}</div><ul>{rows}</ul></article><footer>End</footer>"
    for i, got in enumerate(pages.extract_group(site(prose, range(10), body))):
        assert "phone app" not in got and "Read more" not in got and "Home" not in got
        assert got.startswith(prose(5, i) + "\n\n" + prose(40, 100 + i)) and prose(4, 900 + 10 * i) in got


def test_rows_of_an_unmarked_list_lose_their_repeated_words(prose):
    for i, got in enumerate(pages.extract_group(site(prose, range(10), "<h1>{title}</h1><div>{text}</div><ul>{rows}</ul>"))):
        assert "Read more" not in got and "Home" not in got
        assert prose(40, 100 + i) in got and prose(4, 900 + 10 * i) in got


def test_another_text_in_a_slot_of_the_template_stays(prose):
    html = site(prose, range(20), "<div><p>Constant line.</p><div>{text}</div></div>")
    html[7] = html[7].replace("Constant line.", "Only here.")
    got = pages.extract_group(html)
    assert "Only here." in got[7] and not any("Constant" in t for t in got)


def test_near_copies_keep_their_article(prose):
    html = [f"<article><h1>{prose(3, i)}</h1><p>{prose(60, 1)}</p></article>" for i in range(10)]
    assert all(prose(60, 1) in t for t in pages.extract_group(html))


def test_every_page_has_a_row(spark, prose):
    html = [*site(prose, range(5), "<article><p>{text}</p></article>"), "", None]
    rows = [(i, f"http://a.org/{i}", h) for i, h in enumerate(html)] + [(9, None, "<p>x")]
    got = pages.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: prose(40, 100 + i) for i in range(5)} | {5: "", 6: "", 9: "x"}
