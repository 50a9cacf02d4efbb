from tests.test_entry import without


def test_a_missing_package_is_an_error():
    found = without("xxhash")
    assert found.returncode and "xxhash" in found.stderr


def test_all_operators_are_registered():
    names = without().stdout.split()
    assert [n for n in range(1, 14) if not [q for q in names if q.startswith(f"op{n}_")]] == [] and "pipeline" in names
