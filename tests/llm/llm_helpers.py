"""Helpers of these tests."""


def prose(rng, n, words="alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()):
    return " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))



def collect(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]
