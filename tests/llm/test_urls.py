"""The URL models on addresses written by hand, not made by the rule that makes the labelled ones."""

from spotweave.llm import urls

ACCEPTED = """
https://www.gutenbergpress.example.org/catalogue/pride-and-prejudice
https://rivertownlibrary.example.com/opening-hours
https://blog.annalisaknits.com/2019/11/winter-socks-pattern
http://www.cs.northvalley.edu/~miller/lectures/compilers.html
https://docs.fastgrid.io/en/stable/install.html
https://oldmillbakery.co.uk/our-bread
https://www.stadtwerke-neuburg.de/strom/tarife
https://journals.openbiology.com/article/view/1821
https://gardenersworkshop.com/how-to-prune-roses
https://en.worldhistoryproject.info/wiki/Battle_of_Hastings
https://www.mairie-saintmartin.fr/actualites/travaux
https://trailmaps.example.com/alps/day-hikes
https://www.dailychronicle.example.com/politics/2020/05/council-vote
https://kernel-hackers-guide.example.org/scheduler
https://www.childrensmuseum.example.com/visit
https://cityofmaplewood.example.com/departments/water
https://recipes.grandmaskitchen.com/apple-pie
https://www.astronomersclub.info/forum/viewtopic.php
https://help.mailhaven.io/articles/reset-password
https://www.wanderlust-travel.de/reisen/italien
https://lehrerfortbildung.example.com/mathe
https://www.symphony-hall.example.com/season/tickets
https://birdwatching.example.org/species/robin
https://www.railwaymodellers.co.uk/layouts
https://thequietreader.com/reviews/the-long-road
https://pediatricsclinic.example.com/appointments
https://www.volcano-observatory.example.org/reports/etna
https://solarpowerforum.example.com/threads/inverters
https://www.musiktheater.de/spielplan
https://framework.codersnotes.io/tutorial/part-two
""".split()
REJECTED = """
http://best-casino-bonus.example.com/play-now
http://cheapviagra-online.info/buy
http://www.hot-sexcams.com/live
http://freexxxporn.example.com/videos
http://pokerjackpot.example.com/signup
http://payday-loans-fast.com/apply
http://replica-watches-cheap.com/rolex
http://www.adult-dating-hookup.info/join
http://warez-crack-keygen.com/download
http://click-popup-ads.example.com/redirect
http://earnmoney-fast.info/crypto-bonus
http://miracle-diet-pills.com/order
http://torrentcrack.example.com/full-version
http://sportsbet-slots.com/freespins
http://buyfollowers-likes.com/cheap
http://escort-sexy-girls.example.com/city
http://onlinepharmacy-nomeds.info/pills
http://bitcoin-miner-free.com/coins
http://spamtraffic-seo.com/backlinks
http://winnerprize-giftcards.com/claim
""".split()


def test_held_out_addresses(spark):
    """Few ordinary addresses are blocked and most unwanted ones are; none fits a rule."""
    rows = [(i, u) for i, u in enumerate([*ACCEPTED, *REJECTED])]
    got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules=()).collect()}
    blocked = [u for i, u in rows if got[i] == "block"]
    false_block = sum(u in ACCEPTED for u in blocked) / len(ACCEPTED)
    recall = sum(u in REJECTED for u in blocked) / len(REJECTED)
    assert false_block <= 0.1 and recall >= 0.8, (false_block, recall)
