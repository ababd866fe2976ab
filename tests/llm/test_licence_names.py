"""A licence's name in a notice, and short Creative Commons notices."""

import pytest

from fleetlens.llm import license_scan


def labels(text):
    return {f[0] for f in license_scan.scan(license_scan.joined(text))[1]}


@pytest.mark.parametrize("name", ["BSD", "GPL", "ISC", "MPL", "W3C"])
def test_other_names_are_not_mit(name):
    assert "mit" not in labels(f"It is released under the {name} license.")
    assert "mit" in labels("It is relesed under the MIT license.")


def test_similar_notices_keep_their_own_names():
    mpl, epl = "This Source Code Form is subject to the terms of the Mozilla Public License", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
    assert labels(mpl) == {"mpl"} and labels(epl) == {"epl"}
    assert not labels(mpl.replace("Mozilla", "Eclipse")) and not labels(epl.replace("Eclipse", "Mozilla"))
    lesser = "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"
    assert labels(lesser) == {"lgpl"} and labels(lesser.replace("Lesser ", "")) == {"gpl"}


@pytest.mark.parametrize("text", ["Licensed under CC BY-NC 4.0", "licensed under CC BY 4.0", "This text is available as CC-BY-SA 3.0.", "(c) someone, CC BY 4.0"])
def test_creative_commons(text):
    assert labels(text) == {"cc"}
    assert not labels("an acc by nc and it came by 4 0")
