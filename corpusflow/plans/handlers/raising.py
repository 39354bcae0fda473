"""Fails on every other URL."""


def resolve_pdf_url(url):
    if len(url) % 2:
        raise ValueError(url)
    return url + "#raising"
