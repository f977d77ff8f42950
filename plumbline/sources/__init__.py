"""plumbline.sources"""
