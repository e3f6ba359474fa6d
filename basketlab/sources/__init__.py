"""basketlab.sources"""
