"""Adjacent copies of a notice with different edits are all found."""

import pytest

from lendscape.llm import licenses

MIT = "released under the mit license"
EDITED = "releqqed under the mit license"


@pytest.mark.parametrize(
    "copies, edits",
    [
        ([EDITED, MIT], [2, 0]),
        ([MIT, EDITED], [0, 2]),
        ([EDITED, EDITED, MIT, EDITED, MIT], [2, 2, 0, 2, 0]),
        ([EDITED, MIT.replace("mit", "mxt"), MIT], [2, 1, 0]),
    ],
)
def test_worse_copies_beside_better_ones(copies, edits):
    found = licenses.scanner().find(" ".join(copies))
    assert [(x.label, x.edits) for x in found] == [("mit", e) for e in edits]
    assert all(a.end <= b.start for a, b in zip(found, found[1:]))
