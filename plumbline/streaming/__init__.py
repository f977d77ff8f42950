"""plumbline.streaming"""
