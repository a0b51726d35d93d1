"""orgextract.streaming"""
