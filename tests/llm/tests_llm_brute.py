"""Brute-force forms shared by tests."""
import test_pairs


def brute_first_of_groups(rows):
    groups = test_pairs.brute_groups([test_pairs.brute_fingerprint(t) for _, t in rows])
    return [min((rows[j][0] for j in g if rows[j][0] is not None), default=None) for g in set(groups.values())]


def brute_clean(text, items):
    return not test_pairs.brute_hits(text, items)[3]
