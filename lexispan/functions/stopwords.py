"""Stopword lists.

Both lists are fixed values: results depend on exactly these words.
"""

# The 178 words left out of the index.
CORE_STOPWORDS: tuple[str, ...] = tuple(
    """
    a about above after again against ain all am an and any are aren arent as at
    be because been before being below between both but by
    can couldn couldnt
    d did didn didnt do does doesn doesnt doing don dont down during
    each
    few for from further
    had hadn hadnt has hasn hasnt have haven havent having he her here hers herself
    him himself his how
    i if in into is isn isnt it its itself
    just
    ll
    m ma me mightn mightnt more most mustn mustnt my myself
    needn neednt no nor not now
    o of off on once only or other our ours ourselves out over own
    re
    s same shan shant she shes should shouldn shouldnt shouldve so some such
    t than that thatll the their theirs them themselves then there these they this
    those through to too
    under until up
    ve very
    was wasn wasnt we were weren werent what when where which while who whom why
    will with won wont wouldn wouldnt
    y you youd youll your youre yours yourself yourselves youve
    """.split()
)

# The shorter list of the browser rules.
BROWSER_STOPWORDS: tuple[str, ...] = tuple(
    """
    a an and are as at be been being but by for from has have he her hers him his
    i if in into is it its me my not of on or our she so that the their them there
    they this to was we were what when where which who will with you your
    """.split()
)
