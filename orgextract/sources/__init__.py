"""orgextract.sources"""
